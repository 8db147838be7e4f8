"""Trees of files, written and changed by tasks: a data source with a two-phase commit, and sync plans.

``write(files, root)`` puts (path, content) below a root.

1. Every task of the write puts its files into a folder of its attempt, under a
   staging folder beside the root, and reports that folder and how many files it
   has.  An attempt that fails deletes its folder.  When all tasks are done the
   source's commit writes the list of the attempts that count.
2. A second job moves the files of those attempts to their places, each attempt
   by one task.  Into a root that is not there the whole tree is then renamed at
   once, so readers see no half of it; into one that is there each file goes by
   a rename.  Moving is done again without harm if a task is lost.

The driver sees attempts and never files.  What is left of a write that failed
is one staging folder, and ``abort`` deletes it.

``apply(plan, source, target)`` carries out a sync plan (path, action) in tasks:
deletions first, then copies, each through a file beside its place.

Tasks reach files through pyarrow; ``sinks.put_files`` writes to places that
pyarrow can't reach, through Hadoop in the driver.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from siltstone import lineage
from siltstone.sources import places

COMMITTED = "committed.json"


@dataclass
class Attempt(WriterCommitMessage):
    folder: str
    files: int


def safe(path: str) -> str:
    """A path below a root, or an error for one that leads out of it or nowhere."""
    clean = posixpath.normpath(path or "")
    if not path or path.startswith("/") or clean in (".", "..") or clean.startswith("../"):
        raise ValueError(f"no path below a tree: {path!r}")
    return clean


class TreeWriter(DataSourceArrowWriter):
    """Phase one: attempts write, the job lists those that count."""

    def __init__(self, options: dict):
        self.staging = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        where, root = places.reach(self.staging)
        name = f"attempt-{uuid.uuid4().hex}"
        folder, n = f"{root}/{name}", 0
        where.create_dir(folder, recursive=False)  # an attempt that outlives its job can't bring the staging folder back
        made: set[str] = set()
        try:
            for batch in iterator:
                for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                    clean = safe(path)
                    for i, c in enumerate(clean):
                        if c == "/" and (above := clean[:i]) not in made:
                            where.create_dir(f"{folder}/{above}", recursive=False)
                            made.add(above)
                    with where.open_output_stream(f"{folder}/{clean}") as out:
                        out.write(content or b"")
                    n += 1
        except BaseException:
            if where.get_file_info(folder).type != pafs.FileType.NotFound:
                where.delete_dir(folder)
            raise
        return Attempt(name, n)

    def commit(self, messages: list[Attempt | None]) -> None:
        where, root = places.reach(self.staging)
        places.put(where, f"{root}/{COMMITTED}", json.dumps([[m.folder, m.files] for m in messages if m]).encode())

    def abort(self, messages: list[Attempt | None]) -> None:
        where, root = places.reach(self.staging)
        if where.get_file_info(root).type != pafs.FileType.NotFound:
            where.delete_dir(root)


class Tree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options)


def _published(staging: str, target: str):
    """Phase two of an attempt: its files to their places below the target."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = places.reach(staging)
        _, there = places.reach(target)
        made: set[str] = set()
        for batch in batches:
            for name in batch.column("folder").to_pylist():
                for path, _ in places.files_below(f"{staging}/{name}"):
                    places.replace(where, f"{root}/{name}/{path}", f"{there}/{path}", made)
        yield pa.RecordBatch.from_pydict({"folder": pa.array([], type=pa.string())})

    return move


def write(files: DataFrame, root: str) -> int:
    """(path, content) as files below root; the number of files. Of several rows with one path one stays; a null content is an empty file."""
    spark = files.sparkSession
    lineage.ship(spark)
    spark.dataSource.register(Tree)
    target = root.rstrip("/")
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    where, stage = places.reach(staging)
    there = places.reach(target)[1]
    where.create_dir(stage, recursive=True)
    try:
        files.select("path", F.col("content").cast("binary").alias("content")).write.format("tree").mode("append").save(staging)
    except Exception:
        if where.get_file_info(stage).type != pafs.FileType.NotFound:
            where.delete_dir(stage)
        raise
    with where.open_input_stream(f"{stage}/{COMMITTED}") as f:
        attempts = json.loads(f.read())
    fresh = where.get_file_info(there).type == pafs.FileType.NotFound
    goal = f"{staging}/tree" if fresh else target
    where.create_dir(places.reach(goal)[1], recursive=True)
    if attempts:
        rows = spark.createDataFrame([(a,) for a, n in attempts if n], "folder string") if any(n for _, n in attempts) else None
        if rows is not None:
            rows.repartition(len(attempts)).mapInArrow(_published(staging, goal), "folder string").count()
    if fresh:
        where.create_dir(posixpath.dirname(there), recursive=True)
        where.move(f"{stage}/tree", there)
    where.delete_dir(stage)
    return sum(n for _, n in attempts)


def apply(plan: DataFrame, source: str, target: str) -> int:
    """Carry out a sync plan (path, action); the number of files copied or deleted."""

    def carry(action: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (fro, a), (to, b) = places.reach(source.rstrip("/")), places.reach(target.rstrip("/"))
            n = 0
            for batch in batches:
                for path in batch.column("path").to_pylist():
                    old, new = f"{a}/{safe(path)}", f"{b}/{safe(path)}"
                    if action == "delete":
                        if to.get_file_info(new).is_file:
                            to.delete_file(new)
                    else:
                        part = f"{b}/{posixpath.dirname(path)}/.{posixpath.basename(path)}.{uuid.uuid4().hex}"
                        to.create_dir(posixpath.dirname(new), recursive=True)
                        pafs.copy_files(old, part, source_filesystem=fro, destination_filesystem=to)
                        places.replace(to, part, new)
                    n += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], type=pa.int64())})

        return run

    lineage.ship(plan.sparkSession)
    plan = lineage.cut(plan.select("path", "action"), "sync-plan")  # a plan is a comparison with the target, which changes under it
    done = 0
    for action in ("delete", "copy"):
        counted = plan.where(F.col("action") == action).select("path").mapInArrow(carry(action), "n long").agg(F.sum("n").alias("n")).first()
        done += counted["n"] or 0
    return done
