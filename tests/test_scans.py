"""Trees listed and read by tasks, and what queries over them read."""

import os

from siltstone.plans import files
from siltstone.sources import corpus, runs, scans


def test_tasks_list_and_read_a_tree(spark, tmp_path):
    root = tmp_path / "tree"
    for i in range(300):
        p = root / f"m{i % 3}" / ("deep" if i % 2 else "") / f"{i}.md"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f"text {i}")
    for name in ("m0/_hidden.md", "m0/.hidden.md", "m0/_a=1.md", "m0/other.txt"):
        (root / name).write_text("x")
    found = corpus.whole_files(spark, str(root), "*.md")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "MapInArrow" in plan
    theirs = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(str(root)).selectExpr("path", "decode(content, 'UTF-8') as content")
    got = {r["path"]: r["content"] for r in found.collect()}
    assert got == {r["path"]: r["content"] for r in theirs.collect()} and len(got) == 301
    assert found.rdd.getNumPartitions() > 1
    flat = {os.path.basename(r["path"]) for r in scans.read(spark, str(root / "m0"), "*", recursive=False).collect()}
    assert "other.txt" in flat and "_a=1.md" in flat and "0.md" in flat and "3.md" not in flat
    listed = {r["path"]: r for r in runs.listing(spark, str(root)).collect()}
    assert len(listed) == 302 and listed["m0/other.txt"]["size"] == 1
    (tmp_path / "empty").mkdir()
    assert corpus.whole_files(spark, str(tmp_path / "empty"), "*.md").count() == 0


def test_a_check_reads_its_tree_once(spark):
    """The audit joins the documents three times; what it takes of them has been written before."""
    for query in (files.scanned_audit, files.failure_labels):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "binaryFile" not in plan and "ArrowEvalPython" not in plan
