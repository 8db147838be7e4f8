"""What the operators of this subpackage share: tables, shared folder, cut lineage, bounded Arrow batches."""

from __future__ import annotations

import gc
import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import lineage

#: Rows and bytes of one Arrow batch that Spark hands to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Bytes of text that a vectorised kernel takes at once, so that its arrays stay in a core's cache; a longer text is taken alone, whole.
SLICE_BYTES = 1 << 18

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Ship this package to the executors, once for an application, and bound the Arrow batches of the session.

    Spark reads the bounds when a plan runs, which may be long after an operator has returned it, so they stay set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = Path(tempfile.mkdtemp()) / "siltstone.zip"
    path.write_bytes(body.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; see lineage.shared_dir."""
    return lineage.shared_dir(spark)


def stash(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: this cuts the lineage, so a lost executor costs the tasks of one step only.

    Shuffle files of the steps behind it are of no more use, and Spark deletes them when the driver's garbage is collected;
    that is asked for here, because a driver with much memory would let them fill the executors' disks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    lineage._written.append((spark, path))
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder at once."""
    lineage.remove(spark, path)


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the program ends."""
    lineage._written.append((spark, path))


def drop_stash(df: DataFrame) -> None:
    """Delete the files of a stash that nothing reads any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        lineage.remove(spark, f)


def positional(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, int]]:
    """docs with its columns named by their places, those names, and the place of each old name (the first, if it is there twice).

    Whatever the columns of a table are called (dots, names that differ in case), they can't clash with an operator's own.
    """
    names = [f"column_{i}_of_docs" for i in range(len(docs.columns))]
    at: dict[str, int] = {}
    for i, n in enumerate(docs.columns):
        at.setdefault(n, i)
    return docs.toDF(*names), names, at


def pick(docs: DataFrame, *wanted: str) -> DataFrame:
    """The columns of exactly these names."""
    rows, names, at = positional(docs)
    return rows.select(*[F.col(names[at[w]]).alias(w) for w in wanted])


def release(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> pa.Array:
    return pa.compute.fill_null(pa.compute.binary_length(column), 0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts have no more than this many bytes together, or a single text."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def shared_keys(keyed: DataFrame, *of_key: Column) -> DataFrame:
    """The rows whose key others have, with aggregates of the key, one of them the count n.

    Both sides are shuffled: Spark takes rows that Arrow functions make for as many as went in, so it would broadcast
    the keys of a small table although each row of it gives dozens.
    """
    return keyed.join(keyed.groupBy("key").agg(*of_key).where("n > 1").hint("merge"), "key")


def array(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)
