"""Cutting lineage: a written table in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset a local session, as in tests, gets one on this machine; a cluster, whose machines share none, is an error."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not made.isDefined():
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="siltstone-"))
            made = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = made.get()
    return at.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of a session, once for an application: what they unpickle refers to it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root, body = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = Path(tempfile.mkdtemp()) / "siltstone_library.zip"
    path.write_bytes(body.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def bound_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Bound the Arrow batches of the session: Spark's own bound is 10,000 rows of any size. Spark reads it when a plan runs, so it stays set."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


_written: list[tuple[SparkSession, str]] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if the session is still there."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        pass


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        remove(spark, path)


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df and read it back, so that what follows does not carry its plan and a lost executor costs one step. The files go when the program ends."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _written.append((df.sparkSession, path))
    return df.sparkSession.read.schema(schema).parquet(path)
