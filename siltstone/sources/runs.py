"""Run records, safe trees, stage selection, and trees written and copied: steps around the plans."""

from __future__ import annotations

import json
import re
from datetime import UTC, datetime
from pathlib import Path, PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources import places, scans, sinks, trees


def write_record(spark: SparkSession, path: str, run_id: str, run_dir: str, status: str) -> dict:
    """A run's record; the time of its creation is kept from an earlier record that can be read."""
    if status not in ("running", "complete", "failed"):
        raise ValueError(f"no such status: {status}")
    try:
        earlier = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    except Exception:  # none yet, or none that can be read
        earlier = {}
    created = earlier.get("created_utc") if isinstance(earlier, dict) else None
    now = datetime.now(UTC).replace(microsecond=0).isoformat().replace("+00:00", "Z")
    record = {"schema_version": 1, "run_id": run_id, "created_utc": created if isinstance(created, str) and created else now, "status": status, "pipeline_run_dir": run_dir}
    sinks.put(spark, path, json.dumps(record, indent=2) + "\n")
    return record


def check_trees(source: str, target: str) -> None:
    """Refuse a blank path, equal trees, and one tree inside the other."""
    if not source.strip() or not target.strip():
        raise ValueError("a tree's path must not be empty")
    a, b = (PurePosixPath(Path(p.split("://", 1)[-1]).resolve()) for p in (source, target))
    if a == b or a in b.parents or b in a.parents:
        raise ValueError(f"{a} and {b} are one tree, or one holds the other")


def trees_apart(source: Column, target: Column) -> Column:
    """Whether two trees are named, differ, and none holds the other, by their paths alone (``check_trees`` follows links, too)."""
    clean = lambda p: F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(p), "^[a-z][a-z0-9+.-]*://[^/]*", ""), r"/(?:\.?/)+", "/"), r"/\.?$", ""), F.lit("/"))
    a, b = clean(source), clean(target)
    return (F.trim(source) != "") & (F.trim(target) != "") & ~a.startswith(b) & ~b.startswith(a)


def select_stages(stages: list[str], only: str | None) -> list[str]:
    """All stages; or those with exactly this id, else of this two-digit family, else of this full name. A stage is named ``…-ID-words``."""
    if only is None:
        return list(stages)
    wanted = only.strip().lower()
    ids = {s: (re.search(r"-(\d{2}[a-z]?)-", s) or [None, s])[1].lower() for s in stages}
    tests = (lambda s: ids[s] == wanted, lambda s: bool(re.fullmatch(r"\d{2}", wanted)) and ids[s].startswith(wanted), lambda s: s.lower() == wanted)
    for fits in tests:
        if wanted and (found := [s for s in stages if fits(s)]):
            return found
    raise ValueError(f"no stage fits {only!r}; there are " + ", ".join(ids.values()))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path under root, size, mtime in seconds, is_link) of all files below root."""
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    if places.reachable(root):
        found = scans.listed(spark, root)
        return found.select(F.element_at(F.split("path", base, 2), -1).alias("path"), F.col("length").alias("size"), "mtime", F.lit(False).alias("is_link"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(F.element_at(F.split("path", base, 2), -1).alias("path"), F.col("length").alias("size"), F.col("modificationTime").cast("double").alias("mtime"), F.lit(False).alias("is_link"))


def write_tree(files: DataFrame, root: str) -> int:
    """(path, content) as files below root; the number of files. Tasks write them and commit in two phases; where only Hadoop reaches the root, the driver does."""
    return trees.write(files, root) if places.reachable(root) else sinks.put_files(files, root)


def apply_plan(plan: DataFrame, source: str, target: str) -> int:
    """Carry out a sync plan (path, action) in tasks; the number of files copied or deleted. Where only Hadoop reaches the trees, the driver copies."""
    check_trees(source, target)
    return trees.apply(plan, source, target) if places.reachable(source) and places.reachable(target) else _apply_by_hadoop(plan, source, target)


def _apply_by_hadoop(plan: DataFrame, source: str, target: str) -> int:
    spark = plan.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda root, p: jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{p}")
    done = 0
    for r in plan.where("action in ('copy', 'delete')").toLocalIterator():
        to = at(target, r["path"])
        fs = to.getFileSystem(conf)
        if r["action"] == "delete":
            fs.delete(to, False)
        else:
            if fs.exists(to):
                fs.delete(to, True)  # a folder where a file is to be, too
            fro = at(source, r["path"])
            fs.mkdirs(to.getParent())
            jvm.org.apache.hadoop.fs.FileUtil.copy(fro.getFileSystem(conf), fro, fs, to, False, conf)
        done += 1
    return done
