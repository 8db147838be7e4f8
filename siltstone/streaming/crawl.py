"""An incremental crawl as a stream: landed fetches against what is kept of every page.

Crawls land as files of fetches (url, seq, status, raw, last_modified, is_error,
stored_hash): what came for a page, when in the order of crawls, and the hash of
the output that is now stored for it (null: none).  The stream keeps a record a
url in Spark's keyed state and gives one outcome a fetch:

* ``expired``: last modified before the cutoff, even if nothing changed; the page is forgotten
* ``reuse``: the fetch failed or brought an error page, and the stored output is whole
* ``fail``: likewise, without such an output
* ``skip``: not modified, or the raw text has the hash that is kept, and the output is whole
* ``short``: the text is too short for a page, or is the same as one that was; only its hash is kept
* ``refetch``: as convert, in place of an output that does not fit its record any more
* ``convert``: new or changed

State is keyed by url and written to the checkpoint, so a stream that starts again
goes on where it ended, and a page's record is all that its task holds.  Fetches of
a url in one micro-batch are taken by ``seq``.  A fetch without a url is no page;
a repeated fetch is judged again.  ``plan`` gives the same outcomes for one crawl
in batch, from the records that ``records`` reads off earlier outcomes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from siltstone import lineage

FETCH = "url string, seq long, status int, raw string, last_modified string, is_error boolean, stored_hash string"
OUTCOME = "url string, seq long, action string, raw_hash string, content_hash string, last_modified string, skip_reason string"
RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("raw_hash", "content_hash", "last_modified", "skip_reason")])
Outcome = Row("url", "seq", "action", "raw_hash", "content_hash", "last_modified", "skip_reason")
#: Characters under which a text is no page.
SHORT = 100


def page_hash(raw: str) -> str:
    return hashlib.sha256(raw.encode()).hexdigest()


def content_hash(raw_hash: str) -> str:
    """The hash of the output that is made of a raw text; conversion is outside, so it is named by its source."""
    return hashlib.sha256(f"output of {raw_hash}".encode()).hexdigest()


def content_hash_of(raw: Column) -> Column:
    """``content_hash`` of a text's hash, as a column."""
    return F.sha2(F.concat(F.lit("output of "), F.sha2(raw, 256)), 256)


def missing(v) -> bool:
    return v is None or v != v


def judged(record: tuple | None, fetch, cutoff: str, short: int) -> tuple[str, tuple | None]:
    """(action, record after it) of one fetch."""
    raw_kept, content_kept, modified_kept, reason = record or (None,) * 4
    raw = None if missing(fetch.raw) else fetch.raw
    modified = modified_kept if missing(fetch.last_modified) else fetch.last_modified
    status = None if missing(fetch.status) else int(fetch.status)
    stored = None if missing(fetch.stored_hash) else fetch.stored_hash
    whole = record is not None and content_kept is not None and stored == content_kept
    bad = status is None or status >= 400 or bool(not missing(fetch.is_error) and fetch.is_error) or (status != 304 and raw is None)
    if not missing(fetch.last_modified) and fetch.last_modified < cutoff:
        return "expired", None
    if bad:
        return ("reuse" if whole else "fail"), record
    seen = status == 304 or page_hash(raw) == raw_kept
    if seen and record is not None and reason == "short":
        return "short", record
    if seen and whole:
        return "skip", (raw_kept, content_kept, modified, None)
    if raw is None:  # not modified, but there is nothing whole to keep: the page is fetched anew next time
        return "fail", None
    if len(raw) < short:
        return "short", (page_hash(raw), None, modified, "short")
    action = "refetch" if record is not None and content_kept is not None and not whole else "convert"
    return action, (page_hash(raw), content_hash(page_hash(raw)), modified, None)


class Pages(StatefulProcessor):
    """The record of a url, and what each fetch makes of it."""

    def __init__(self, cutoff: str, short: int):
        self.cutoff, self.short = cutoff, short

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("record", RECORD)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = record = tuple(self.kept.get()) if self.kept.exists() else None
        for f in sorted(rows, key=lambda f: f.seq):
            action, record = judged(record, f, self.cutoff, self.short)
            yield Outcome(key[0], f.seq, action, *(record or (None,) * 4))
        if record is None and kept is not None:
            self.kept.clear()
        elif record != kept:
            self.kept.update(record)

    def close(self) -> None:
        pass


def outcomes(fetches: DataFrame, cutoff: str, short: int = SHORT) -> DataFrame:
    """The outcomes of a stream of fetches. The session's state store must hold processors (see ``run``)."""
    lineage.ship(fetches.sparkSession)
    return fetches.where("url is not null").groupBy("url").transformWithState(Pages(cutoff, short), OUTCOME, outputMode="append", timeMode="none")


def run(spark, landed: str, out: str, checkpoint: str, cutoff: str, short: int = SHORT, files_a_batch: int = 1000) -> None:
    """Take in all crawls that have landed since the last run: Parquet files of fetches below ``landed`` to outcomes below ``out``. Both folders and the checkpoint are shared ones."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fetches = spark.readStream.schema(FETCH).option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").parquet(landed)
    query = outcomes(fetches, cutoff, short).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def records(found: DataFrame) -> DataFrame:
    """(url, raw_hash, content_hash, last_modified, skip_reason) as they stand after the outcomes: of each url the last that leaves one."""
    last = F.row_number().over(W.partitionBy("url").orderBy(F.desc("seq")))
    return found.withColumn("n", last).where("n = 1 and raw_hash is not null").drop("n", "seq", "action")


def plan(fetches: DataFrame, kept: DataFrame, cutoff: str, short: int = SHORT) -> DataFrame:
    """The outcomes of one crawl, a fetch a url at most, as a join with the records that are kept; expressions only."""
    k = kept.select("url", F.struct("raw_hash", "content_hash", "last_modified", "skip_reason").alias("kept"))
    raw_hash = F.sha2("raw", 256)
    was: Column = F.col("kept").isNotNull()
    whole = F.coalesce(was & (F.col("kept.content_hash") == F.col("stored_hash")), F.lit(False))
    bad = F.col("status").isNull() | (F.col("status") >= 400) | F.coalesce("is_error", F.lit(False)) | ((F.col("status") != 304) & F.col("raw").isNull())
    seen = (F.col("status") == 304) | F.coalesce(raw_hash == F.col("kept.raw_hash"), F.lit(False))
    action = (
        F.when(F.col("last_modified") < cutoff, "expired")
        .when(bad, F.when(whole, "reuse").otherwise("fail"))
        .when(seen & was & F.coalesce(F.col("kept.skip_reason") == "short", F.lit(False)), "short")
        .when(seen & whole, "skip")
        .when(F.col("raw").isNull(), "fail")
        .when(F.length("raw") < short, "short")
        .when(was & F.col("kept.content_hash").isNotNull() & ~whole, "refetch")
        .otherwise("convert")
    )
    rows = fetches.where("url is not null").join(k, "url", "left").withColumn("action", action).withColumn("hash", raw_hash)
    modified = F.coalesce("last_modified", "kept.last_modified")
    text_, kind = (lambda c: F.lit(c).cast("string")), "struct<raw_hash:string,content_hash:string,last_modified:string,skip_reason:string>"
    fresh = F.struct("hash", content_hash_of(F.col("raw")), modified, text_(None)).cast(kind)
    short_now = F.struct("hash", text_(None), modified, text_("short")).cast(kind)
    after = (
        F.when(F.col("action").isin("convert", "refetch"), fresh)
        .when(F.col("action") == "skip", F.struct("kept.raw_hash", "kept.content_hash", modified, text_(None)).cast(kind))
        .when(F.col("action") == "short", F.when(seen & was & (F.col("kept.skip_reason") == "short"), F.col("kept")).otherwise(short_now))
        .when(F.col("action").isin("reuse", "fail") & bad, F.col("kept"))
    )
    return rows.withColumn("after", after).select("url", "seq", "action", "after.*")
