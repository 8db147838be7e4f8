"""Packing, numbering, roots, reports and checks added beside the first set."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from siltstone.operators import layout, release, store, threads
from siltstone.sources import corpus, sinks


def greedy(sizes, budget):
    out, used, part = [], 0, 0
    for n in sizes:
        if part == 0 or used + n > budget:
            part, used = part + 1, n
        else:
            used += n
        out.append(part)
    return out


@pytest.mark.parametrize("budget,parts", [(10, 1), (10, 7), (100, 5), (3, 4), (0, 3)])
def test_shards_equal_a_plain_fold(spark, budget, parts):
    r = random.Random(budget + parts)
    rows = [(m, i, r.choice([None, 0, 1, 2, 5, 9, 30])) for m, n in (("a", 200), ("b", 1), (None, 23), ("c", 57)) for i in range(n)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(r.sample(rows, len(rows)), "module string, file int, token_count int")
        got = {(x["module"], x["file"]): x["part"] for x in layout.shards(df, budget).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for m in ("a", "b", None, "c"):
        mine = [(i, n or 0) for g, i, n in rows if g == m]
        assert [got[m, i] for i, _ in mine] == greedy([n for _, n in mine], budget)
    assert layout.shards(df.limit(0), budget).count() == 0


@pytest.mark.parametrize("budget", [0, 7, 40, 400])
def test_runs_of_runs_of_blocks(spark, budget):
    """Many blocks of one module, two summaries a task."""
    r = random.Random(budget)
    rows = [("a" if i < 900 else "b", i, r.choice([0, 1, 3, 8, 45])) for i in range(1000)]
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = {x["file"]: x["part"] for x in layout.shards(spark.createDataFrame(rows, "module string, file int, token_count int").repartition(9), budget, fan=2).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for m in "ab":
        assert [got[i] for g, i, _ in rows if g == m] == greedy([n for g, _, n in rows if g == m], budget)


def test_composed_summaries_do_what_the_blocks_do():
    import numpy as np
    import pandas as pd

    r = random.Random(2)
    for _ in range(300):
        budget = r.choice([0, 5, 20])
        blocks = [[r.choice([0, 1, 4, 9]) for _ in range(r.randint(1, 6))] for _ in range(r.randint(1, 5))]
        rows = pd.concat([layout._summary(pd.DataFrame({"block": b, "n": n}), budget) for b, n in enumerate(blocks)])
        total, sums, used, parts = layout._arrays(next(layout._folded(rows, budget).itertuples()))
        sizes = [x for b in blocks for x in b]
        for u in range(budget + 2):
            held, started = u, 0
            for n in sizes:
                held, started = (n, started + 1) if held + n > budget else (held + n, started)
            i = int(np.searchsorted(sums, budget - u, side="right"))
            assert ((int(used[i]), int(parts[i])) if i < len(sums) else (u + total, 0)) == (held, started)


def test_shards_of_one_module_take_linear_time(spark):
    took = []
    for n in (20_000, 80_000):
        df = spark.range(n).select(F.lit("m").alias("module"), F.col("id").alias("file"), (F.col("id") % 997).alias("token_count"))
        layout.shards(df, 5000).count()
        began = time.time()
        assert layout.shards(df, 5000).count() == n
        took.append(time.time() - began)
    assert took[1] < 4 * took[0] + 2


def test_numbers_over_many_partitions(spark):
    r = random.Random(4)
    rows = [(f"t{i}", r.choice(["Alpha", "alpha", "beta"]), r.choice([30, 30, 30, 90])) for i in range(500)]
    df = spark.createDataFrame(rows, "thread_id string, subject string, score_cents int").repartition(9)
    got = {x["thread_id"]: x["number"] for x in threads.numbered(df).collect()}
    want = sorted(rows, key=lambda x: (-x[2], x[1].lower(), x[0]))
    assert [got[t] for t, _, _ in want] == list(range(1, 501))


def test_a_long_cycle_with_tails(spark):
    parents = {f"c{i}": f"c{(i + 1) % 150}" for i in range(150)} | {f"t{i}": f"t{i + 1}" for i in range(40)} | {"t40": "c7"}
    got = {x["id"]: x["root"] for x in threads.roots(spark.createDataFrame(list(parents.items()), "id string, parent string")).collect()}
    assert all(got[f"c{i}"] == f"c{i}" for i in range(150)) and all(got[f"t{i}"] == "c6" for i in range(41))


def test_a_match_across_two_messages(spark):
    rows = [("1", "r", "a@x", "s", "nothing but you should", "2024-01-01", 0, 0, "f"), ("2", "r", "b@x", "s", "use calloc here", "2024-01-02", 0, 1, "f"), ("3", "q", "a@x", "s", "plain", "2024-01-01", 0, 0, "f")]
    from test_threads import messages

    got = {x["thread_id"]: x["score_cents"] for x in threads.rollup(messages(spark, rows)).collect()}
    from siltstone.functions import fixed

    across = __import__("re").search(fixed.CORRECTION, "should\nuse", __import__("re").I) is not None
    assert got["r"] - got["q"] >= (30 if across else 0)


def test_promote_preflight_cap_and_scratch(spark):
    a = spark.createDataFrame([("m", "x", 1), ("m", "y", 1)], "module string, slug string, v int")
    b = spark.createDataFrame([("m", "y", 2), ("m", "z", 2)], "module string, slug string, v int")
    out, n = store.promote(a, b)
    assert n == 2 and {(r["slug"], r["v"]) for r in out.collect()} == {("x", 1), ("y", 2), ("z", 2)}
    with pytest.raises(ValueError):
        store.promote(a, b.limit(0))
    decided = spark.createDataFrame([("a", "generate"), ("b", "skip"), ("c", "generate"), ("d", "generate")], "slug string, decision string")
    assert {r["slug"]: r["decision"] for r in store.capped(decided, 2, "slug").collect()} == {"a": "generate", "b": "skip", "c": "generate", "d": "waiting"}
    assert [d.count() for d in store.scratch(a, b, b)] == [2, 2, 2]


def test_rerun_guard(spark):
    m = lambda *x: spark.createDataFrame([(i,) for i in x], "module string")
    assert {r["module"] for r in layout.missing_on_rerun(m("a", "b", "c"), m("a")).collect()} == {"b", "c"}
    assert layout.missing_on_rerun(m("a", "b"), m("a", "new")).count() == 0


def test_files_are_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "sub" / "f.txt")
    sinks.put(spark, path, "one")
    sinks.put(spark, path, "two é")
    assert open(path, encoding="utf-8").read() == "two é" and [p.name for p in (tmp_path / "sub").iterdir() if not p.name.startswith(".")] == ["f.txt"]


def test_pairs_of_page_and_sidecar(spark, tmp_path):
    docs = spark.createDataFrame([("uci", "c_source", "a", "text", {"k": "v", "module": "other"}), ("uci", "readme", "b", None, None)], "module string, origin_type string, slug string, content string, metadata map<string,string>")
    assert sinks.put_files(sinks.raw_pairs(docs), str(tmp_path)) == 4
    assert (tmp_path / "uci/c_source-a.md").read_text() == "text"
    side = json.loads((tmp_path / "uci/c_source-a.meta.json").read_text())
    assert side["k"] == "v" and side["module"] == "uci" and side["content_hash"] == "982d9e3e"


def test_bounded_reports(spark):
    found = spark.createDataFrame([("base", "m", f"s{i:03}", "error" if i % 3 else "warning", "wrong") for i in range(30)], "store string, module string, slug string, severity string, message string")
    lines = sinks.check_report(found, errors=5, warnings=50).splitlines()
    assert sum(x.startswith("error: m/") for x in lines) == 5 and "error: ... and 15 more" in lines and sum(x.startswith("warning: m/") for x in lines) == 10 and len(lines) == 16


def test_summaries_in_headers(spark):
    rows = [("title: T\nai_summary: old\nmodule: m", "Body.\n", 'New "one" with $1 \\ and é', "Always.", ["a", "b"]), ("title: U", "B", None, None, None)]
    docs = spark.createDataFrame(rows, "frontmatter string, body string, ai_summary string, ai_when_to_use string, ai_related_topics array<string>")
    got = [r["content"] for r in release.inject_summary(docs).collect()]
    head = got[0].split("---\n")[1]
    assert [x.split(":")[0] for x in head.splitlines()] == ["title", "ai_summary", "module", "ai_when_to_use", "ai_related_topics"]
    assert json.loads(head.splitlines()[1].split(": ", 1)[1]) == rows[0][2] and json.loads(head.splitlines()[4].split(": ", 1)[1]) == ["a", "b"] and got[0].endswith("---\nBody.\n")
    assert got[1] == "---\ntitle: U\n---\nB"


def test_json_values_side_by_side(spark):
    lines = spark.createDataFrame([('{"v": "a}{b"}{"v": "c"} {"v":"d"}',), ('{"v": "e"',), ("",), (None,)], "value string")
    assert [r["v"] for r in corpus.concatenated_json(lines, "v string").collect()] == ["a}{b", "c", "d"]


def test_fetched_pages(spark):
    rows = [("https://wiki.example.org/a", None, "<p>text</p>"), ("https://other.org/a", None, ""), ("https://wiki.example.org/b", "https://other.org/login", "x"), ("https://example.org:80/c", "https://wiki.example.org/c", "Just a moment..."), ("https://example.org.evil.net/", None, "x")]
    df = spark.createDataFrame(rows, "url string, final string, html string")
    got = [r["v"] for r in df.select(corpus.fetched_verdict(F.col("url"), F.col("final"), F.col("html"), "example.org").alias("v")).collect()]
    assert got == ["kept", "off-site", "redirected", "challenge", "off-site"]


def test_sources_as_documents(spark, tmp_path):
    files = spark.createDataFrame([("a.c", "/**\n * Opens it.\n * @x\n */\nint open(int x)\n{\n}\n/* plain */\n/** Second. */ void f;\n")], "path string, content string")
    assert [(r["comment"], r["declares"]) for r in corpus.documented(files).orderBy("ordinal").collect()] == [("Opens it.\n@x", "int open(int x)"), ("Second.", "void f")]
    make = spark.createDataFrame([("Makefile", "PKG_NAME:=one\nPKG_VERSION:=1\nPKG_VERSION:=2\nOTHER:=x\n")], "path string, content string")
    assert {(r["key"], r["value"]) for r in corpus.makefile_metadata(make).collect()} == {("PKG_NAME", "one"), ("PKG_VERSION", "2")}
    (tmp_path / "cook").mkdir()
    (tmp_path / "cook/soup.md").write_text("---\ntitle: Soup\nlevel: easy\n---\nBoil.\n")
    (tmp_path / "cook/plain.md").write_text("No header.")
    got = {r["slug"]: r for r in corpus.cookbook(spark, str(tmp_path)).collect()}
    assert got["soup"]["metadata"] == {"title": "Soup", "level": "easy"} and got["soup"]["content"] == "Boil.\n" and got["plain"]["content"] == "No header."


def test_tree_checks(spark):
    good = {"llms.txt": "# T\n- [a](a/llms.txt)\n" + "x" * 600, "llms-full.txt": "", "README.md": "", "AGENTS.md": "", "index.html": '<a href="./a/llms.txt">a</a>', "a/llms.txt": "", "a/map.md": "", "a/bundled-reference.md": "", "a/chunked-reference/p.md": "# p"}
    tree = lambda files: spark.createDataFrame(list(files.items()), "path string, content string")
    modules = spark.createDataFrame([("a",)], "module string")
    assert layout.tree_problems(tree(good), modules, least_modules=1).count() == 0 and layout.page_problems(tree(good)).count() == 0
    bad = good | {"index.html": '<a href="gone.html">', "a/chunked-reference/x.txt": "t", "a/chunked-reference/q.md": "---\ntitle: x\nupstream_path: y\n---\n", "a/e.html": "<html><title>404 Not Found</title>"}
    found = {(r["check"], r["subject"]) for r in layout.page_problems(tree(bad)).collect()}
    assert found == {("index names a file that is not there", "gone.html"), ("index lacks a module", "a/llms.txt"), ("not Markdown", "a/chunked-reference/x.txt"), ("stale field", "a/chunked-reference/q.md"), ("error page", "a/e.html")}


def test_banner_and_relative_paths(spark):
    assert release.missing_names({"core": "1", "web": None, "x": " "}) == ["web", "x"]
    df = spark.createDataFrame([("file:/data/tree/a/b.md",), ("/data/tree/c.md",), ("/else/d.md",)], "p string")
    assert [r["r"] for r in df.select(corpus.relative(F.col("p"), "file:///data/tree").alias("r")).collect()] == ["a/b.md", "c.md", "/else/d.md"]
