"""Sources, sinks, Markdown and mail, over small files written here."""

import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions import mail, markdown
from siltstone.operators import processing, store
from siltstone.sources import corpus, sinks


@pytest.fixture()
def tree(tmp_path):
    def put(path, content):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(content, newline="")

    put("l2/uci/a.md", "---\ntitle: A page\nmodule: uci\ntoken_count: 12\n---\nBody of a.\n")
    put("l2/uci/b.md", "---\r\ntitle: B\r\n---\r\nBody of b.\r\n")
    put("l2/wiki/bad.md", "---\n[not: a: mapping\n---\nx")
    put("l2/wiki/none.md", "no header")
    put("l2/wiki/list.md", "---\n- a\n- b\n---\nx")
    put("base/uci/a.json", json.dumps({"slug": "a", "content_hash": None, "ai_related_topics": ["t"]}))
    put("base/uci/b.json", "{broken")
    put("base/uci/ignored.txt", "{}")
    put("base/wiki/list.json", "[1, 2]")
    put("cache.json", json.dumps({"k1": {"summary": "s", "when_to_use": "w", "related_topics": ["t"]}, "k2": "text"}))
    put("m2.json", json.dumps({"core": "1111111"}))
    put("m3.json", "[1]")
    return tmp_path


def test_documents_and_records(spark, tree):
    good, bad = corpus.documents(spark, str(tree / "l2"))
    rows = {r["slug"]: r for r in good.collect()}
    assert rows.keys() == {"a", "b"} and rows["a"]["title"] == "A page" and rows["a"]["token_count"] == 12 and rows["a"]["body"] == "Body of a.\n" and rows["b"]["title"] == "B"
    import hashlib

    assert rows["a"]["body_hash"] == hashlib.sha256(b"Body of a.\n").hexdigest()[:12]
    assert {r["path"].rsplit("/", 1)[1] for r in bad.collect()} == {"bad.md", "none.md", "list.md"}
    found = corpus.records(spark, str(tree / "base"), "base")
    assert {r["path_slug"]: r["readable"] for r in found.collect()} == {"a": True, "b": False, "list": False}
    audited = store.audit(good, corpus.layer(found), corpus.layer(found).limit(0))
    assert {r["slug"]: r["status"] for r in audited.collect()} == {"a": "base_pinned", "b": "invalid_base", "list": "orphan_base"}
    assert {r["slug"] for r in corpus.targets(spark, str(tree / "l2")).collect()} == {"a", "b", "bad", "none", "list"}


def test_cache_and_manifest(spark, tree):
    (r,) = corpus.legacy_cache(spark, str(tree / "cache.json")).collect()
    assert (r["hash"], r["summary"], r["related_topics"]) == ("k1", "s", ["t"])
    found, path = corpus.manifest(spark, [str(tree / "m1.json"), str(tree / "m2.json")])
    assert path.endswith("m2.json") and corpus.commits({"core": None, "web": "2222222", "x": None}, found) == {"core": "1111111", "web": "2222222", "x": "unknown"}
    for paths in ([str(tree / "m3.json")], [str(tree / "m1.json")], [str(tree / "base/uci/b.json")]):
        with pytest.raises(corpus.ManifestError):
            corpus.manifest(spark, paths)


def test_policy(spark, tree):
    (tree / "p.yml").write_text("- source: wiki\n  identifier: x\n  match_type: exact\n  reason: old\n- source: wiki\n  identifier: y\n")
    assert [(r["identifier"], r["reason"]) for r in corpus.policy(spark, str(tree / "p.yml")).orderBy("ordinal").collect()] == [("x", "old"), ("y", None)]
    assert corpus.policy(spark, str(tree / "none.yml")).count() == 0


def test_scenarios_and_concatenated_json(spark):
    doc = spark.createDataFrame([("# T\n\n## Scenario 01\nOne.\n\n---\n## Scenario 02\nTwo.\n",)], "content string")
    meta = spark.createDataFrame([("01", "net")], "id string, domain string")
    assert {(r["id"], r["body"], r["domain"]) for r in corpus.scenarios(doc, meta).collect()} == {("01", "One.", "net"), ("02", "Two.", None)}
    lines = spark.createDataFrame([('{"v": "PASS"}{"v": "FAIL"}',), ('{"v": "PASS"}',), ("",)], "value string")
    got = corpus.concatenated_json(lines, "v:string").groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"PASS": 2, "FAIL": 1}


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("uci", "c_source", "a", "text", {"k": "v"})], "module string, origin_type string, slug string, content string, metadata map<string,string>")
    sinks.raw_documents(docs, str(tmp_path / "l1"))
    (r,) = spark.read.json(str(tmp_path / "l1")).collect()
    assert r["file"] == "c_source-a.md" and r["content_hash"] == "982d9e3e" and r["module"] == "uci"
    sinks.json_lines(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"a":1,"b":null}'
    sinks.readme(spark, str(tmp_path / "README.md"), "Title", ["one", "two"])
    assert (tmp_path / "README.md").read_text() == "# Title\n\n- one\n- two\n"
    df = spark.range(100)
    assert sinks.sample(df, "id", 1).collect() == sinks.sample(df.repartition(7), "id", 1).collect() and sinks.sample(df, "id", 1).collect() != sinks.sample(df, "id", 2).collect()


ARCHIVE = b"""From joe at example.org  Mon Jan  1 10:00:00 2024
From: joe at example.org (Joe =?utf-8?q?D=C3=B6?=)
Date: Mon, 01 Jan 2024 10:00:00 +0100 (CET)
Subject: [PATCH v2] package: fix crash
Message-ID: <1@x>

The build is broken, error: in package/net/foo.c since 1234567.
-- 
Joe
From ann at example.org  Tue Jan  2 10:00:00 2024
From: Ann <ann@example.org>
Date: Tue, 02 Jan 2024 10:00:00 +0000
Subject: Re: [PATCH v2] package: fix crash
Message-ID: <2@x>
In-Reply-To: <1@x>
References: <1@x>
Content-Type: multipart/mixed; boundary=b

--b
Content-Type: text/plain; charset=iso-8859-1
Content-Transfer-Encoding: base64

PiB0aGUgYnVpbGQgaXMgYnJva2VuCllvdSBzaG91bGQgdXNlIGNhbGxvYyBpbnN0ZWFkLgpkaWZmIC0tZ2l0IGEvcGFja2FnZS94LmMgYi9wYWNrYWdlL3guYwpAQCAtMSw2ICsxLDYgQEAgaW50IG1haW4oKQorYQorYgorYworZAorZQorZgpFbmQ=
--b--
From bot at example.org  Tue Jan  2 11:00:00 2024
From: noreply at github.com
Subject: CI run
Message-ID: <3@x>

An error: somewhere in a long enough body of the message.
"""


def test_mail_from_bytes_to_lessons(spark, tmp_path):
    (tmp_path / "in/devel").mkdir(parents=True)
    (tmp_path / "in/devel/2024-January.txt").write_bytes(ARCHIVE)
    (tmp_path / "in/empty.txt").write_bytes(b"no message here")
    parsed = corpus.parsed_archives(spark, str(tmp_path / "in"), {"devel/": "https://lists.example.org/devel/"})
    rows = {r["message_id"]: r for r in parsed.collect()}
    assert len(parsed.columns) == 23 and rows.keys() == {"<1@x>", "<2@x>", "<3@x>"}
    a, b, c = (rows[f"<{i}@x>"] for i in (1, 2, 3))
    assert a["byte_offset"] == 0 and b["byte_offset"] == ARCHIVE.index(b"From ann") and a["archive_url"] == "https://lists.example.org/devel/2024-January.txt"
    assert (a["from_addr"], a["from_name"], a["date_raw"], a["date_iso"]) == ("joe@example.org", "", "Mon, 01 Jan 2024 10:00:00 +0100", "2024-01-01T10:00:00+01:00")
    assert a["body_for_scoring"] == "The build is broken, error: in package/net/foo.c since 1234567." and a["mentioned_files"] == ["package/net/foo.c"] and a["mentioned_commits"] == ["1234567"]
    assert b["in_reply_to"] == "<1@x>" and b["references"] == ["<1@x>"] and b["body_no_diff"].endswith("[diff: package/x.c]\n[hunk: int main()]\n+a\n+b\n+c\n+d\n+e") and b["mentioned_files"] == ["package/x.c"]
    (pair,) = b["quoted_context_pairs"]
    assert pair["quoted"] == "the build is broken" and pair["line_index"] == 1 and pair["response"].startswith("You should use calloc")
    assert (a["disposition"], b["disposition"], c["disposition"]) == ("primary", "primary", "dropped") and a["has_patch_subject"]
    s = processing.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    (t,) = s["threads"].collect()
    assert t["thread_id"] == "<1@x>" and t["message_count"] == 2 and t["author_count"] == 2
    # problem 30, correction 30, authors 15, references 10, messages 10, subject revision 5
    assert t["score_cents"] == 100
    (lesson,) = s["lessons"].collect()
    assert lesson["title"] == "package: fix crash: mistake and correction" and lesson["fix"]["from"] == "ann@example.org" and lesson["completeness"]["level"] == "complete"
    assert mail.parse_stats(s["messages"]).first()["keyword_match_rate"] == 100.0
    assert "package: fix crash" in (tmp_path / "out/reports/common-problems.md").read_text() and spark.read.json(str(tmp_path / "out/parsed/messages-dropped")).count() == 1


def fenced(*codes):
    return "\n\n".join(f"```\n{c}\n```" for c in codes) + "\n"


def test_languages_of_bare_fences():
    page = fenced("$ ls -l /tmp\ntotal 0", '[1, {"depth": 2}]', "a … b", "for (let i = 0; i < 3; i++) print(i);")
    assert [lang for lang, _ in markdown.code_blocks(markdown.normalise_fences(page, "ucode"))] == ["bash", "json", "text", "ucode"]
    named = "```python\nprint(1)\n```\n"
    assert markdown.normalise_fences(named, "ucode") == named


def test_code_in_a_list_loses_its_indent():
    assert markdown.code_blocks("1. First\n\n   ```sh\n   make\n     all\n   ```\n") == [("sh", "make\n  all")]


def test_imports_and_prose(spark):
    code = "import 'socket';\nimport { a, b } from 'math';\nimport * as z from 'zlib';\nimport { c } from 'math';\n"
    page = "Before.\n\n~~~c\nint hidden;\n~~~\n\nAfter.\n"
    r = spark.createDataFrame([(code, page)], "c string, m string").select(markdown.imports(F.col("c")).alias("i"), markdown.without_fences(F.col("m")).alias("m")).first()
    assert r["i"] == ["math", "socket", "zlib"] and "hidden" not in r["m"] and r["m"].split() == ["Before.", "After."]


def test_names_that_a_language_reserves_are_imported_by_their_module():
    out = markdown.namespaced_imports("import { lookup, const } from 'geo';\nlet p = lookup('x');\nif (p > const.LIMIT) p = 0;\n")
    assert out == "import * as geo from 'geo';\nlet p = geo.lookup('x');\nif (p > geo.const.LIMIT) p = 0;\n"


def cells(*rows, head=0):
    line = lambda r, tag: "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in r) + "</tr>"
    return "<table>" + "".join(line(r, "th" if i < head else "td") for i, r in enumerate(rows)) + "</table>"


def test_marks_of_the_wiki_go():
    out = markdown.clean_wiki("P", "# P\n\n\\<WRAP center box\\>Take \\<color blue\\>**care**\\</color\\> of it.\\</WRAP\\>\n\n\\<sortable 2\\>\n")
    assert "Take **care** of it." in out and not any(x in out for x in ("WRAP", "color", "sortable", "\\<"))


def test_tables_of_few_columns_become_markdown():
    out = markdown.clean_wiki("T", cells(("Port", "Use"), ("22", "login"), ("22", "login"), ("80", "first<br />second"), ("<code>x</code>", "<em>y</em>"), head=1))
    assert "| Port | Use |" in out and out.count("| 22 | login |") == 1 and "| 80 | first; second |" in out and "| `x` |" in out and "<t" not in out


def test_tables_of_many_columns_become_tabs():
    out = markdown.clean_wiki("W", cells(tuple("ABCDE"), tuple("vwxyz"), head=1))
    assert "```tsv\nA\tB\tC\tD\tE\nv\tw\tx\ty\tz\n```" in out


def test_a_table_of_a_picture_and_a_text_is_a_warning():
    out = markdown.clean_wiki("B", cells(('<img src="/stop.svg" alt="stop" />', 'Read <a href="/new/page">this</a> first.')))
    assert "> [!WARNING]" in out and "[this](/new/page)" in out and "<img" not in out


def test_joined_cells_stay_html():
    kept = '<table><tr><td colspan="2">both</td></tr><tr><td>left</td><td>right</td></tr></table>'
    assert kept in markdown.clean_wiki("J", kept) and markdown.clean_wiki("J", None) == ""


def test_footnotes_and_repeated_titles():
    note = '<aside id="footnotes" class="footnotes"><ol><li id="fn3">By hand. <a class="footnote-back" href="#fnref3">up</a></li></ol></aside>'
    out = markdown.clean_wiki("F", f'Measured <u>twice</u><a href="#fn3" class="footnote-ref" id="fnref3"><sup>3</sup></a>.\n\n{note}\n')
    assert "Measured **twice**[^3]." in out and "[^3]: By hand." in out and "aside" not in out
    assert markdown.clean_wiki("S", "# Set up\n\n## SET UP\n\nNow.\n").lower().count("set up") == 1


def test_symbols_are_linked_outside_code():
    out = markdown.link_symbols("Use uci.get or `uci.get`, then uci.get and fs.readfile().\n```\nuci.get()\n```\n[uci.get](x)", {"uci.get": "u.md", "fs.readfile": "f.md"})
    assert out == "Use [uci.get](u.md) or `uci.get`, then uci.get and [fs.readfile()](f.md).\n```\nuci.get()\n```\n[uci.get](x)"


def test_census(spark):
    pages = spark.createDataFrame([("# A\n\n## a\n\nx",), ("<WRAP> <wrap> <table>",), (None,)], "content string")
    r = markdown.artifact_census(pages).first()
    assert (r["files"], r["wrap_files"], r["wrap_count"], r["html_table_files"], r["duplicate_headings"], r["status"]) == (3, 1, 2, 1, 1, "abnormal")
    assert markdown.artifact_census(spark.createDataFrame([("fine",)] * 80, "content string")).first()["status"] == "normal"
