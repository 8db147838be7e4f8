import pytest
from pyspark.sql import functions as F

from siltstone.functions import fixed
from siltstone.operators import layout, store

RECORD = "module string, slug string, content_hash string, readable boolean"


@pytest.fixture()
def world(spark):
    docs = spark.createDataFrame([("m", s, "T", "h" * 12) for s in "abcdefg"], "module string, slug string, title string, body_hash string")
    base = spark.createDataFrame([("m", "a", "h" * 12, True), ("m", "b", "x" * 12, True), ("m", "c", None, True), ("m", "d", None, False), ("m", "e", "h" * 12, True), ("m", "f", "h" * 12, True), ("m", "z", None, True)], RECORD)
    override = spark.createDataFrame([("m", "e", None, True), ("m", "f", None, False), ("m", "a", "x" * 12, True), ("n", "y", None, True)], RECORD)
    return docs, base, override


def test_lookup_falls_through_an_unreadable_override_but_not_through_a_stale_one(world):
    got = {r["slug"]: (r["store"], r["status"]) for r in store.lookup(*world).collect()}
    assert got == {"a": ("override", "stale"), "b": ("base", "stale"), "c": ("base", "ok"), "d": (None, "missing"), "e": ("override", "ok"), "f": ("base", "ok"), "g": (None, "missing")}


def test_audit_does_not_fall_through(world):
    audited = store.audit(*world)
    got = {(r["module"], r["slug"]): r["status"] for r in audited.collect()}
    assert got == {("m", "a"): "override_stale", ("m", "b"): "base_stale", ("m", "c"): "base_pinned", ("m", "d"): "invalid_base", ("m", "e"): "override_pinned", ("m", "f"): "invalid_override", ("m", "g"): "missing", ("m", "z"): "orphan_base", ("n", "y"): "orphan_override"}
    totals = store.audit_totals(store.audit_counts(audited))
    assert totals.first().asDict() == {"current": 0, "pinned": 2, "stale": 2, "missing": 1, "invalid": 2, "orphan": 2}
    assert store.failure_labels(totals).first()["labels"] == ["missing=1", "stale=2", "orphan=2", "invalid=2"]
    assert {r["store"]: r["n"] for r in store.stats(*world[1:]).collect()} == {"base": 6, "override": 3}


def test_fork_and_upsert(spark, world):
    _, base, override = world
    keys = spark.createDataFrame([("m", "b"), ("m", "d"), ("m", "e")], "module string, slug string")
    (r,) = store.fork(base, override, keys).collect()
    assert (r["slug"], r["content_hash"], r["model"]) == ("b", None, "manual-override")
    new = spark.createDataFrame([("m", "a", "n" * 12, True), ("m", "new", None, True)], RECORD)
    out = {r["slug"]: r["content_hash"] for r in store.upsert(base, new).collect()}
    assert len(out) == 8 and out["a"] == "n" * 12
    saved = store.save(base.withColumn("generated_at", F.lit("g")).withColumn("pipeline_version", F.lit("v")).withColumn("saved_at", F.lit("s")), new.withColumn("generated_at", F.lit(None).cast("string")).withColumn("pipeline_version", F.lit(None).cast("string")), "now").collect()
    assert {(r["generated_at"], r["saved_at"]) for r in saved if r["slug"] in ("a", "new")} == {("now", "now")} and len(saved) == 8


GOOD = dict(store="base", path_module="m", path_slug="a", module="m", slug="a", title="T", content_hash="0123456789ab", ai_summary="S", ai_when_to_use="W", ai_related_topics=["t"], generated_at="2026-03-09T00:00:00Z", saved_at=None, model="x", pipeline_version=fixed.RECORD_VERSION, present=list(fixed.REQUIRED_FIELDS))
TYPES = {"ai_related_topics": "array<string>", "present": "array<string>"}


def found(spark, documents=None, warn=(), **changes):
    row = {**GOOD, **changes}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {TYPES.get(k, 'string')}" for k in row))
    return [(r["severity"], r["message"]) for r in store.issues(df, documents, warn).collect()]


def test_record_checks(spark):
    assert found(spark) == []
    for change in (dict(slug="b"), dict(module="n"), dict(title=" "), dict(content_hash="XYZ"), dict(store="override"), dict(ai_summary=None), dict(ai_when_to_use=""), dict(ai_related_topics=[]), dict(ai_related_topics=["a", " "]), dict(generated_at="soon"), dict(generated_at="2026-02-30T00:00:00"), dict(saved_at="x"), dict(model=""), dict(pipeline_version="v11")):
        assert len(found(spark, **change)) == 1, change
    assert found(spark, present=["slug"], model="", title="")[0][1].startswith("missing required fields module, title") and len(found(spark, present=["slug"], model="")) == 1
    for fine in ("2026-03-09", "2026-03-09T10:00", "2026-03-09T10:00:00.123+02:00", "2026-03-09 10:00:00"):
        assert found(spark, generated_at=fine) == []


def test_checks_against_documents(spark):
    docs = spark.createDataFrame([("m", "a", "Other", "ffffffffffff")], "module string, slug string, title string, body_hash string")
    assert [m for _, m in found(spark, docs)] == ["title does not match the document", "content_hash does not match the document's body"]
    assert found(spark, docs.limit(0), warn=("orphan",)) == [("warning", "no matching document found")]


def test_validation_stops_at_loader_issues(spark, world):
    issues = spark.createDataFrame([("error",), ("warning",), ("error",)], "severity string")
    assert store.validation_totals(world[1], issues) == (7, 2, 1)
    assert store.validation_totals(world[1], issues, spark.createDataFrame([("p", "bad")], "path string, problem string")) == (0, 1, 0)


def sharded(spark, sizes, budget):
    df = spark.createDataFrame([("w", f"{i:03d}", n) for i, n in enumerate(sizes)], "module string, file string, token_count long")
    return [r["tokens"] for r in layout.part_totals(layout.shards(df, budget)).orderBy("part").collect()]


def test_shards(spark):
    assert sharded(spark, [60000, 55000, 30000], 100000) == [60000, 85000]
    assert sharded(spark, [200, 1, 99, 1, 300], 100) == [200, 100, 1, 300]
    assert sharded(spark, [], 10) == [] and sharded(spark, [0, 0], 10) == [0]


def test_drift(spark):
    a = spark.createDataFrame([("f", "f()"), ("g", "g()"), ("h", None)], "symbol string, signature string")
    b = spark.createDataFrame([("f", "f(x)"), ("i", "i()"), ("h", None)], "symbol string, signature string")
    assert {r["symbol"]: r["change"] for r in layout.drift(a, b).collect()} == {"f": "changed", "g": "removed", "i": "added"}
    one = lambda *m: spark.createDataFrame([(x,) for x in m], "module string")
    assert layout.module_drift(one("a", "b"), None).count() == 0
    assert {(r["module"], r["change"]) for r in layout.module_drift(one("a", "b"), one("b", "c")).collect()} == {("a", "added"), ("c", "removed")}
    lost = lambda e, i: sorted(r["module"] for r in layout.missing_on_rerun(one(*e), one(*i)).collect())
    assert lost("abc", "a") == ["b", "c"] and lost("abc", "ax") == [] and lost("abc", "abc") == [] and lost("ab", "cd") == []


def test_links(spark):
    pages = spark.createDataFrame([("m/a.md", "[x](b.md) [y](../n/c.md#top) [z](https://e.org/q.md) [w](#h) [v](/root.md) [u](pic.png) [t](./sub/../b.md)")], "path string, content string")
    assert {r["target"]: r["resolved"] for r in layout.links(pages).collect()} == {"b.md": "m/b.md", "../n/c.md#top": "n/c.md", "/root.md": "root.md", "pic.png": "m/pic.png", "./sub/../b.md": "m/b.md"}
    paths = spark.createDataFrame([("m/b.md",), ("root.md",)], "path string")
    assert [r["resolved"] for r in layout.dead_links(pages, paths).collect()] == ["n/c.md"]


@pytest.mark.parametrize(
    "target,link,want",
    [
        ("stable", "[x](../mod/page-a.md)", "[x](../L2-semantic/mod/page-a.md)"),
        ("release", "[x](../mod/page-a.md)", "[x](../mod/chunked-reference/page-a.md)"),
        ("chunked", "[x](../mod/page-a.md)", "[x](../../mod/chunked-reference/page-a.md)"),
        *[(t, "[x](../../mod/page-a.md)", "[x](../../mod/page-a.md)") for t in ("stable", "release", "chunked")],
        ("release", "[x](../mod/p.md#a)", "[x](../mod/chunked-reference/p.md#a)"),
    ],
)
def test_link_rewriting(spark, target, link, want):
    assert spark.createDataFrame([(link,)], "c string").select(layout.rewrite_links(F.col("c"), target).alias("x")).first()["x"] == want


def test_sync_plan(spark):
    schema = "path string, size long, mtime double, is_link boolean"
    s = spark.createDataFrame([("same", 1, 5.0, False), ("time", 1, 5.02, False), ("size", 2, 5.0, False), ("new", 1, 1.0, False), ("link", 1, 1.0, True), ("x/.git", 1, 1.0, False)], schema)
    t = spark.createDataFrame([("same", 1, 5.005, False), ("time", 1, 5.0, False), ("size", 1, 5.0, False), ("old", 1, 1.0, False)], schema)
    plan = lambda d: {r["path"]: r["action"] for r in layout.sync_plan(s, t, d, (".git",)).collect()}
    assert plan(True) == {"same": "skip", "time": "copy", "size": "copy", "new": "copy", "old": "delete"} and plan(False)["old"] == "keep"


def test_tree_problems(spark):
    files = {p: "x" * 600 for p in layout.ROOT_FILES} | {f"{m}/{f}": "x" for m in "abcd" for f in (*layout.MODULE_FILES, "chunked-reference/t.md")}
    tree = lambda f: spark.createDataFrame(list(f.items()), "path string, content string")
    modules = spark.createDataFrame([(m,) for m in "abcd"], "module string")
    assert layout.tree_problems(tree(files), modules).count() == 0
    files["a/map.md"] = "[gone](nowhere.md)"
    files["llms.txt"] = "short"
    files["index.html"] = '<a href="../out">'
    del files["b/map.md"], files["c/chunked-reference/t.md"]
    got = {(r["check"], r["subject"]) for r in layout.tree_problems(tree(files), modules).collect()}
    assert got == {("dead link", "a/map.md -> a/nowhere.md"), ("router too small", "llms.txt"), ("link out of the tree", "index.html"), ("module file missing", "b/map.md"), ("no chunked pages", "c")}


def test_cache_plan(spark):
    a = spark.createDataFrame([("new", 200, "h", "2024-01-01", False), ("eq", 200, "h", "2024-01-01", False), ("nm", 304, None, "2024-01-01", False), ("old", 200, "h", "2019-01-01", False), ("err", 500, None, "2024-01-01", False), ("page", 200, "h", "2024-01-01", True), ("bad", 404, None, "2024-01-01", False), ("cor", 304, None, "2024-01-01", False)], "url string, status int, raw_hash string, last_modified string, is_error boolean")
    c = spark.createDataFrame([(u, "h", u == "cor") for u in ("eq", "nm", "old", "err", "page", "cor", "gone")], "url string, raw_hash string, corrupted boolean")
    got = {r["url"]: r["action"] for r in layout.cache_plan(a, c, "2020-01-01").collect()}
    assert got == {"new": "convert", "eq": "skip", "nm": "skip", "old": "expired", "err": "reuse", "page": "reuse", "bad": "fail", "cor": "refetch", "gone": "orphan"}
    assert {r["url"]: r["action"] for r in layout.cache_plan(a, c, "2020-01-01", complete=False).collect()}["gone"] == "keep"


@pytest.mark.parametrize(("most", "want"), [(0, []), (2, [0, 1, 2, 3]), (3, [0, 1, 2, 3, 4, 5]), (99, [0, 1, 2, 3, 4, 5])])
def test_a_cap_by_successes(spark, most, want):
    """Failures cost nothing; a call that says stop is the last one."""
    outcomes = ["failure", "success", "failure", "success", "failure", "stop", "success", "success"]
    df = spark.createDataFrame(list(enumerate(outcomes)), "i int, outcome string").repartition(3)
    got = {r["i"]: r["state"] for r in store.capped_by_success(df, most, "i").collect()}
    assert sorted(i for i, s in got.items() if s == "made") == want and len(got) == 8


def test_a_cap_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'success', 'failure') as outcome").repartition(7)
    got = store.capped_by_success(df, 700, "id")
    assert got.where("state = 'made'").selectExpr("max(id) m", "count(*) n").first() == (2097, 2098)
