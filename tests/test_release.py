import re
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.operators import layout, release, store
from siltstone.sources import packages, runs


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([("a.md", "Call uci.get and fs.open.\n```\nold.call()\n```\n"), ("b.md", "See old.call, `uci.get` and nothing."), ("c.md", None)], "path string, content string")


@pytest.fixture()
def registry(spark):
    return spark.createDataFrame([("uci.get", "u.md", False), ("old.call", "o.md", True), ("fs.open", "a.md", False)], "symbol string, target string, deprecated boolean")


def test_links_and_warnings(docs, registry):
    linked = {r["path"]: r["content"] for r in release.link(docs, registry.select("symbol", "target")).collect()}
    assert linked["a.md"].startswith("Call [uci.get](u.md) and fs.open.") and "[old.call](o.md)" in linked["b.md"] and "`uci.get`" in linked["b.md"] and linked["c.md"] is None
    warned = {r["path"]: r["content"] for r in release.warn_of_deprecated(docs, registry).collect()}
    assert warned["b.md"].startswith("> [!WARNING]\n> Deprecated: old.call\n\nSee") and not warned["a.md"].startswith(">")


def test_declarations(spark):
    rows = [("m", "b", [("x", False), ("y-z", True)]), ("m", "a", []), ("m", "a", [])]
    df = spark.createDataFrame(rows, "module string, name string, parameters array<struct<name:string,optional:boolean>>")
    assert release.declarations(df).first()["source"] == 'declare module "m" {\n    export function a(): any;\n    export function b(x: any, y_z?: any): any;\n}'


def test_indexes(spark):
    df = spark.createDataFrame([("m", "b.md", "B.", 5, "low"), ("m", "a.md", None, 7, None), ("m", "c.md", "C.", None, "high")], "module string, file string, short string, token_count long, routing_priority string")
    r = release.module_index(df).first()
    assert r["tokens"] == 12 and [x.split("]")[0] for x in r["index"].split("\n")[3:]] == ["- [c.md", "- [b.md", "- [a.md"]
    modules = spark.createDataFrame([("uci", "Core", "Config.", 3), ("wiki", "Manuals", None, 4), ("procd", "Core", "Init.", 5)], "module string, category string, description string, tokens long")
    r = release.root_index(modules).first()
    assert r["tokens"] == 12 and re.findall(r"## (\w+)|\[(\w+)\]", r["index"]) == [("Core", ""), ("", "procd"), ("", "uci"), ("Manuals", ""), ("", "wiki")]
    assert release.banner({"core/core": "1111111", "web": "unknown"}) == "core/core@1111111, web@unknown"
    got = {r["module"]: r["commit"] for r in release.with_commit(modules, {"uci": "core", "procd": "core"}, {"core": "abc1234"}).collect()}
    assert got == {"uci": "abc1234", "procd": "abc1234", "wiki": None}


def test_repair(spark):
    schema = "module string, slug string, title string, content_hash string, generated_at string, readable boolean"
    base = spark.createDataFrame([("m", "a", "Old", "h", "g", True), ("m", "b", "T", None, None, True), ("m", "c", "Old", "x", "g", True), ("m", "d", "T", "h", "g", True), ("m", "e", "Old", "h", "g", True)], schema)
    docs = spark.createDataFrame([("m", s, "T", "h") for s in "abcde"], "module string, slug string, title string, body_hash string")
    got = {r["slug"]: (r["title"], r["generated_at"]) for r in store.repaired(docs, base, base.where("slug = 'e'"), "now").collect()}
    assert got == {"a": ("T", "g"), "b": ("T", "now")}


def test_runs(spark, tmp_path):
    path = str(tmp_path / "run.json")
    first = runs.write_record(spark, path, "r1", "tmp/r1", "running")
    done = runs.write_record(spark, path, "r1", "tmp/r1", "complete")
    assert first["created_utc"] == done["created_utc"] and done["status"] == "complete"
    with pytest.raises(ValueError):
        runs.write_record(spark, path, "r1", "tmp/r1", "odd")
    stages = ["x-02a-wiki.py", "x-02b-repo.py", "x-03-normalise.py"]
    assert runs.select_stages(stages, "02a") == stages[:1] and runs.select_stages(stages, "02") == stages[:2] and runs.select_stages(stages, "x-03-normalise.py") == stages[2:] and runs.select_stages(stages, None) == stages
    for bad in ("09", "", "x"):
        with pytest.raises(ValueError):
            runs.select_stages(stages, bad)


def test_sync_of_trees(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for p, c in (("x/1.txt", "one"), ("2.txt", "two")):
        (a / p).parent.mkdir(parents=True, exist_ok=True)
        (a / p).write_text(c)
    b.mkdir()
    (b / "old.txt").write_text("old")
    plan = layout.sync_plan(runs.listing(spark, str(a)), runs.listing(spark, str(b)), delete_extra=True)
    assert runs.apply_plan(plan, str(a), str(b)) == 3 and (b / "x/1.txt").read_text() == "one" and not (b / "old.txt").exists()
    for s, t in ((str(a), str(a)), (str(a), str(a / "x")), (str(a / "x"), str(a)), ("", str(b)), (str(a), " ")):
        with pytest.raises(ValueError):
            runs.check_trees(s, t)


def test_package(spark, tmp_path):
    (tmp_path / "tree/m").mkdir(parents=True)
    (tmp_path / "tree/m/llms.txt").write_text("x")
    local = packages.package(spark, str(tmp_path / "tree"), str(tmp_path / "p"), "docs", "tmp/pipeline-20260328-7f3c", False, date(2026, 3, 28))
    assert local.endswith("/docs-2026-03-28-7f3c.zip") and zipfile.ZipFile(local).namelist() == ["docs/m/llms.txt"]
    assert packages.package(spark, str(tmp_path / "tree"), str(tmp_path / "p"), "docs", "tmp/x", True, date(2026, 3, 28)).endswith("/docs-2026-03-28.zip")


def test_provenance_goes_in_front(spark):
    df = spark.createDataFrame([("authored", None, None, "2026-03-22T00:00:00Z", "Body.")], "origin_type string, source_url string, source_commit string, last_pipeline_run string, body string")
    assert release.with_provenance(df, "2026-01-01").first()["content"] == "> **Kind:** authored\n> **Method:** hand-authored\n> **Normalized:** 2026-03-22\n\nBody."
    line = release.skeleton_line(F.lit("T"), F.lit("f.md"), F.lit(None).cast("string"), F.lit("Sum."), F.lit("D."))
    assert df.select(line.alias("x")).first()["x"] == "- [T](./f.md): Sum."
