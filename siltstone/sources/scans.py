"""Trees of files as tables: tasks list the folders, and tasks read the files.

``listed(root)`` goes down a tree level by level.  A folder is listed by a task,
and what it holds is written in the shared folder: the driver sees neither files
nor folders, only how many there are.  ``read`` deals the files over so many tasks
that each has about ``TASK_BYTES`` or ``TASK_FILES``, by a hash of the path, and
hands them on in batches of ``BATCH`` bytes; a file is a row, so of 2 GB at most.

As with Spark's readers, names that begin with a dot or an underscore (without a
``=`` in them) are hidden.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import lineage
from siltstone.sources import places

#: Bytes and files of a task, both about; bytes of a batch that it hands on.
TASK_BYTES, TASK_FILES, BATCH = 64 << 20, 20_000, 4 << 20
LISTING = "path string, length long, mtime double, folder boolean"


def hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def shown(root: str, path: str) -> str:
    """A path as Spark's readers name it: with the scheme of the root."""
    if places.plain(root).startswith("/"):
        return f"file:{path}"
    scheme, rest = root.split("://", 1)
    return f"{scheme}://{rest.split('/', 1)[0]}{path}" if path.startswith("/") else f"{scheme}://{path}"


def _entries(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = places.reach(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = [f for f in where.get_file_info(pafs.FileSelector(folder)) if not hidden(f.base_name)]
                for i in range(0, len(found), 1 << 14):
                    some = found[i : i + (1 << 14)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f.path for f in some], type=pa.string()),
                            pa.array([f.size or 0 for f in some], type=pa.int64()),
                            pa.array([(f.mtime_ns or 0) // 1_000_000 / 1000 for f in some], type=pa.float64()),
                            pa.array([f.type == pafs.FileType.Directory for f in some], type=pa.bool_()),
                        ],
                        names=["path", "length", "mtime", "folder"],
                    )

    return run


def listed(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, mtime in seconds) of the files below a root whose name fits the pattern; the root may be a file."""
    lineage.ship(spark)
    where, top = places.reach(root.rstrip("/"))
    info = where.get_file_info(top)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(root)
    if info.is_file:
        return spark.createDataFrame([(top, info.size, (info.mtime_ns or 0) // 1_000_000 / 1000)], "path string, length long, mtime double")
    folders, levels = spark.createDataFrame([(top,)], "path string"), []
    while True:
        level = lineage.cut(folders.mapInArrow(_entries(root), LISTING), "listing")
        levels.append(level.where("not folder").select("path", "length", "mtime"))
        n = level.where("folder").count() if recursive else 0
        if not n:
            break
        folders = level.where("folder").select("path").repartition(min(n, 1000), "path")
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found if pattern == "*" else found.where(F.element_at(F.split("path", "/"), -1).rlike(fnmatch.translate(pattern).replace(r"\Z", r"\z")))


def _contents(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = places.reach(root)
        paths, contents, held = [], [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shown(root, p) for p in paths], type=pa.string()), pa.array(contents, type=pa.binary())], names=["path", "content"])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with where.open_input_stream(path) as f:
                    contents.append(f.read())
                paths.append(path)
                held += len(contents[-1])
                if held >= BATCH or len(paths) >= 1000:
                    yield batch_of()
                    paths, contents, held = [], [], 0
        if paths:
            yield batch_of()

    return run


def read(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, content) of the files below a root whose name fits the pattern."""
    files = listed(spark, root, pattern, recursive)
    n, total = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(-(-n // TASK_FILES), -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-n // 100)), 1)
    return files.select("path").repartition(tasks, "path").mapInArrow(_contents(root), "path string, content binary")
