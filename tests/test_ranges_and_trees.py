"""Archives read by ranges of bytes, and trees written by tasks: whatever the cuts, the same messages; whatever fails, nothing left."""

import io
import os
import random

import pytest
from pyspark.sql import functions as F

from siltstone.functions import mail
from siltstone.sources import corpus, mbox, places, runs, trees

LINE = b"From a at b.c  Mon Mar  9 10:00:00 2026"
BITS = [LINE + b"\n", LINE + b"  \n\n", b"From x@y  Tue Apr 12 01:02:03 2024\n", b"From\nz at q  Mon Mar  9 10:00:00 2026\n", b"From me to you\n", b"text ", b"\n", b"\n\n \n", b"Subject: s\n", b">" + LINE + b"\n", b"From a at\nFrom  Mon Mar  9 10:00:00 2026\n", b"\r\n", b"From ", b"x" * 50 + b"\n", LINE + b" x\n", b"\xff\xfe\n", b"Fro", b"From From at at  Mon Mar  9 10:00:00 2026\n"]


@pytest.mark.parametrize("read", [7, 16, 64, 1000])
def test_any_cut_gives_the_messages_of_the_whole_file(monkeypatch, read):
    monkeypatch.setattr(mbox, "READ", read)
    r = random.Random(read)
    for _ in range(400):
        raw, size = b"".join(r.choice(BITS) for _ in range(r.randint(0, 25))), r.choice([1, 5, 17, 40, 100, 1000])
        got = []
        for part in mbox.planned([("f", len(raw))], size):
            for _, lo, hi in part.ranges:
                got += [(o, mail.BOUNDARY.match(m)[0].decode("utf-8", "replace").strip(), m.partition(b"\n")[2]) for o, m in mbox.read_range(io.BytesIO(raw), lo, hi, len(raw))]
        assert got == mail.split(raw)


def test_ranges_cut_large_files_and_put_small_ones_together():
    got = [p.ranges for p in mbox.planned([("a", 250), ("b", 10), ("c", 20), ("d", 0)], 100)]
    assert got == [[("a", 0, 100)], [("a", 100, 200)], [("a", 200, 250), ("b", 0, 10), ("c", 0, 20)]]


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    os.makedirs(tmp_path / "devel")
    body = lambda i: LINE + b"\nSubject: s%d\n\n" % i + b"word " * (i % 300) + b"\n"
    (tmp_path / "devel" / "all.txt").write_bytes(b"head\n" + b"".join(body(i) for i in range(3000)))
    (tmp_path / "none.txt").write_bytes(b"no message")
    (tmp_path / "other.md").write_bytes(body(1))
    got = mbox.read(spark, str(tmp_path), 50_000)
    want = mail.messages(corpus.archives(spark, str(tmp_path)))
    assert got.select(F.spark_partition_id()).distinct().count() > 20
    assert got.count() == 3000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_tree_is_published_whole(spark, tmp_path):
    root = str(tmp_path / "deep" / "tree")
    files = spark.range(500).select(F.concat(F.lit("m"), (F.col("id") % 7).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".md")).alias("path"), F.when(F.col("id") > 0, F.concat(F.lit("t"), F.col("id").cast("string"))).alias("content")).repartition(6)
    assert runs.write_tree(files, root) == 500
    read = {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n)).read() for d, _, names in os.walk(root) for n in names}
    assert len(read) == 500 and read["m0/0.md"] == "" and read["m2/499.md"] == "t499"
    assert os.listdir(tmp_path / "deep") == ["tree"]
    assert runs.write_tree(files.limit(3).withColumn("content", F.lit("new")), root) == 3  # over what is there
    again = [open(os.path.join(d, n)).read() for d, _, names in os.walk(root) for n in names]
    assert len(again) == 500 and again.count("new") == 3 and os.listdir(tmp_path / "deep") == ["tree"]
    assert runs.write_tree(files.limit(0), str(tmp_path / "empty")) == 0 and (tmp_path / "empty").is_dir()


@pytest.mark.parametrize("bad", ["../x", "/etc/x", "", "a/../../b", "."])
def test_a_write_that_fails_leaves_nothing(spark, tmp_path, bad):
    files = spark.range(50).select(F.when(F.col("id") == 31, bad).otherwise(F.col("id").cast("string")).alias("path"), F.lit("x").alias("content")).repartition(5)
    with pytest.raises(Exception, match="no path below a tree"):
        trees.write(files, str(tmp_path / "t"))
    assert os.listdir(tmp_path) == []


def test_attempts_that_do_not_count_are_not_published(spark, tmp_path):
    """A second attempt of a task, and a lost one, leave no file: only what the commit lists is moved."""
    options = {"path": str(tmp_path / "s")}
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"path": ["a", "b/c"], "content": [b"1", None]})
    w = trees.TreeWriter(options)
    with pytest.raises(OSError):
        w.write(iter([batch]))  # the job is over, or has not begun
    (tmp_path / "s").mkdir()
    lost, kept = w.write(iter([batch])), w.write(iter([batch]))
    w.commit([kept, None])
    assert lost.folder != kept.folder and kept.files == 2
    list(trees._published(options["path"], str(tmp_path / "t"))(iter([pa.RecordBatch.from_pydict({"folder": [kept.folder]})])))
    assert places.files_below(str(tmp_path / "t")) == [("a", 1), ("b/c", 0)]
    w.abort([kept])
    assert not (tmp_path / "s").exists()


def test_plans_are_carried_out_by_tasks(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for p, t in ((a / "x/1", "one"), (a / "f", "file"), (a / "g/deep", "d"), (b / "f/was/folder", "z"), (b / "old", "o"), (b / "g", "was a file")):
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(t)
    plan = spark.createDataFrame([("x/1", "copy"), ("f", "copy"), ("g", "delete"), ("g/deep", "copy"), ("old", "delete"), ("gone", "delete"), ("k", "skip")], "path string, action string").repartition(3)
    assert runs.apply_plan(plan, str(a), str(b)) == 6
    assert places.files_below(str(b)) == [("f", 4), ("g/deep", 1), ("x/1", 3)]


def test_trees_apart(spark):
    cases = [("/a/b", "/a/b", False), ("/a/b", "/a/b/c", False), ("/a/b/c", "/a/b", False), ("/a/b", "/a/bc", True), ("", "/a", False), ("/a", "  ", False), ("/a//b/./c", "/a/b/c", False), ("/a/b/", "/a/b", False), ("hdfs://h/a", "/a/x", False)]
    df = spark.createDataFrame(cases, "a string, b string, w boolean")
    assert [r["g"] for r in df.select(runs.trees_apart(F.col("a"), F.col("b")).alias("g")).collect()] == [c[2] for c in cases]


def test_small_ranges_share_tasks():
    """Ranges of 32 KB are no task each, and ranges that follow one another are read as one; all bytes are read once."""
    files = [("a", 40 << 20), ("b", 10), ("c", 3 << 20)]
    parts = mbox.planned(files, 1 << 15)
    got = mbox.dealt(parts, mbox.TASK)
    assert len(parts) > 1000 and 6 <= len(got) <= 8
    assert all(sum(hi - lo for _, lo, hi in p.ranges) <= mbox.TASK for p in got)
    flat = [r for p in got for r in p.ranges]
    assert len(flat) < 12 and all(sum(hi - lo for n, lo, hi in flat if n == name) == size for name, size in files)


def test_batches_of_messages_are_bounded(spark):
    from siltstone.functions import mail

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    raw = spark.createDataFrame([("f", 0, "From x", b"Subject: a\n\nb")], "source_file string, byte_offset long, from_line string, message binary")
    assert mail.records(raw).count() == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000 and int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
