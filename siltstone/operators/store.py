"""Layered record stores: precedence, staleness, audit, validation and upserts.

A store has records keyed by (module, slug) in a ``base`` and an ``override``
layer.  Records are DataFrames with the columns of RECORD; ``readable`` is false
for a file that is there but holds no JSON object.  Documents have module, slug,
title and body_hash.
"""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from siltstone.functions import fixed, text
from siltstone.lineage import cut

KEY = ["module", "slug"]
FIELDS = ("title", "content_hash", "ai_summary", "ai_when_to_use", "ai_related_topics", "generated_at", "saved_at", "model", "pipeline_version")


def as_layer(records: DataFrame, name: str) -> DataFrame:
    """The key, a struct ``name`` of all other columns, and ``name_exists``; a key that is there twice counts once (the first in the order of its values)."""
    others = [c for c in records.columns if c not in KEY]
    packed = records.select(*KEY, F.struct(*others).alias(name))
    return packed.groupBy(*KEY).agg(F.min(name).alias(name)).withColumn(f"{name}_exists", F.lit(True))


def lookup(documents: DataFrame, base: DataFrame, override: DataFrame) -> DataFrame:
    """Each document with its active record and its status: the first *readable* of override and base.

    missing: none; ok: the record has no hash, or the document none, or they are
    equal; stale: they differ.  A stale override is stale, whatever base has.
    """
    b, o = as_layer(base, "base"), as_layer(override, "override")
    joined = documents.join(o, KEY, "left").join(b, KEY, "left")
    active = F.when(F.col("override.readable"), F.col("override")).when(F.col("base.readable"), F.col("base"))
    layer = F.when(F.col("override.readable"), "override").when(F.col("base.readable"), "base")
    out = joined.select(*documents.columns, active.alias("record"), layer.alias("store"))
    stored = F.col("record.content_hash")
    status = F.when(F.col("store").isNull(), "missing").when(stored.isNull() | F.col("body_hash").isNull() | (stored == F.col("body_hash")), "ok").otherwise("stale")
    return out.withColumn("status", status)


def classify(stored: Column, body_hash: Column) -> Column:
    """pinned without a stored hash, current if it is the body's, else stale."""
    return F.when(stored.isNull(), "pinned").when(stored == body_hash, "current").otherwise("stale")


def audit(documents: DataFrame, base: DataFrame, override: DataFrame) -> DataFrame:
    """(module, slug, status) of every document and every orphan.

    Here an override blocks base even if it is unreadable.  Statuses are
    ``{layer}_{current,pinned,stale}``, ``invalid_{layer}``, ``missing`` and
    ``orphan_{layer}``.
    """
    b, o = as_layer(base, "base"), as_layer(override, "override")
    joined = documents.select(*KEY, "body_hash").join(o, KEY, "left").join(b, KEY, "left")

    def state(name: str) -> Column:
        return F.when(F.col(f"{name}.readable"), F.concat(F.lit(f"{name}_"), classify(F.col(f"{name}.content_hash"), F.col("body_hash")))).otherwise(f"invalid_{name}")

    status = F.when(F.col("override_exists"), state("override")).when(F.col("base_exists"), state("base")).otherwise("missing")
    known = joined.select(*KEY, status.alias("status"))
    keys = documents.select(*KEY)
    orphans = [layer.join(keys, KEY, "left_anti").select(*KEY, F.lit(f"orphan_{name}").alias("status")) for name, layer in (("base", b), ("override", o))]
    return known.unionByName(orphans[0]).unionByName(orphans[1])


def audit_counts(audited: DataFrame) -> DataFrame:
    return audited.groupBy("status").agg(F.count("*").alias("n"))


def audit_totals(counts: DataFrame) -> DataFrame:
    """One row: sums over both layers of current, pinned, stale, invalid and orphan, and missing."""
    total = lambda pattern: F.coalesce(F.sum(F.when(F.col("status").rlike(pattern), F.col("n"))), F.lit(0)).alias
    return counts.agg(total("_current$")("current"), total("_pinned$")("pinned"), total("_stale$")("stale"), total("^missing$")("missing"), total("^invalid_")("invalid"), total("^orphan_")("orphan"))


def failure_labels(totals: DataFrame, wanted: tuple[str, ...] = ("missing", "stale", "orphan", "invalid")) -> DataFrame:
    """One row of ``name=count`` labels of the wanted categories that are not zero."""
    return totals.select(F.array_compact(F.array(*[F.when(F.col(c) > 0, F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in wanted])).alias("labels"))


def stats(base: DataFrame, override: DataFrame) -> DataFrame:
    """(store, n): readable records of each layer."""
    both = base.withColumn("store", F.lit("base")).unionByName(override.withColumn("store", F.lit("override")))
    return both.where("readable").groupBy("store").agg(F.count("*").alias("n"))


def iso_text(value: str | None) -> bool:
    """Whether a text is an ISO 8601 date or time as Python's library reads it; a Z in its end is UTC."""
    try:
        datetime.fromisoformat(value[:-1] + "+00:00" if value.endswith("Z") else value)
    except (AttributeError, ValueError):
        return False
    return True


@pandas_udf(T.BooleanType())
def _iso(values: pd.Series) -> pd.Series:
    return values.map(iso_text).astype(bool)


def is_iso(value: Column) -> Column:
    """Whether a text is an ISO 8601 date or time. Two dates a record: what is read as such is the library's rule, which no pattern has whole."""
    return _iso(value)


def issues(records: DataFrame, documents: DataFrame | None = None, warn: tuple[str, ...] = ()) -> DataFrame:
    """(store, module, slug, severity, message) of every failed check of the records.

    Records have store, path_module, path_slug, the fields of RECORD and
    ``present``, the names of the fields that are there.  A record that lacks a
    required field has that one issue only.  With documents, orphans, other titles
    and other hashes are found too; ``warn`` names those that are warnings.
    """
    filled = lambda c: F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
    lacking = F.filter(F.array(*[F.lit(f) for f in fixed.REQUIRED_FIELDS]), lambda f: ~F.array_contains(F.col("present"), f))
    topics = F.col("ai_related_topics")
    # fixed values: the messages of the checks
    checks = [
        (~F.col("slug").eqNullSafe(F.col("path_slug")), "slug does not match path"),
        (~F.col("module").eqNullSafe(F.col("path_module")), "module does not match path"),
        (~filled("title"), "title must be a non-empty string"),
        (F.col("content_hash").isNotNull() & ~F.col("content_hash").rlike("^[0-9a-f]{12}$"), "content_hash must be null or 12-char lowercase hex"),
        ((F.col("store") == "override") & F.col("content_hash").isNotNull(), "content_hash must be null for human-pinned overrides"),
        (~filled("ai_summary"), "ai_summary must be non-empty text"),
        (~filled("ai_when_to_use"), "ai_when_to_use must be non-empty text"),
        (F.coalesce(F.size(topics), F.lit(0)) <= 0, "ai_related_topics must be a non-empty list"),
        (F.coalesce(F.exists(topics, lambda x: F.coalesce(F.trim(x), F.lit("")) == ""), F.lit(False)), "ai_related_topics entries must be non-empty strings"),
        (~is_iso(F.col("generated_at")), "generated_at must be ISO 8601 text"),
        (F.col("saved_at").isNotNull() & ~is_iso(F.col("saved_at")), "saved_at must be ISO 8601 text"),
        (~filled("model"), "model must be non-empty text"),
        (~F.col("pipeline_version").eqNullSafe(F.lit(fixed.RECORD_VERSION)), f"pipeline_version must be {fixed.RECORD_VERSION}"),
    ]
    rows = records
    referential = []
    if documents is not None:
        known = documents.select(F.col("module").alias("path_module"), F.col("slug").alias("path_slug"), F.col("title").alias("doc_title"), F.col("body_hash").alias("doc_hash"), F.lit(True).alias("has_doc"))
        rows = records.join(known, ["path_module", "path_slug"], "left")
        has = F.coalesce("has_doc", F.lit(False))
        referential = [
            ("orphan", ~has, "no matching document found"),
            ("title", has & filled("title") & (F.trim("title") != F.col("doc_title")), "title does not match the document"),
            ("hash", has & F.col("content_hash").isNotNull() & (F.col("content_hash") != F.col("doc_hash")), "content_hash does not match the document's body"),
        ]
    issue = lambda cond, severity, message: F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(message).alias("message")))
    every = [issue(c, "error", m) for c, m in checks] + [issue(c, "warning" if k in warn else "error", m) for k, c, m in referential]
    short = F.struct(F.lit("error").alias("severity"), F.concat(F.lit("missing required fields "), F.array_join(lacking, ", ")).alias("message"))
    found = F.when(F.size(lacking) > 0, F.array(short)).otherwise(F.array_compact(F.array(*every)))
    return rows.select("store", F.col("path_module").alias("module"), F.col("path_slug").alias("slug"), F.explode(found).alias("i")).select("store", "module", "slug", "i.*")


def validation_totals(records: DataFrame, found: DataFrame, loader_issues: DataFrame | None = None) -> tuple[int, int, int]:
    """(records checked, errors, warnings); any issue of loading the documents stops the check: no record is checked and each issue is an error."""
    if loader_issues is not None and (n := loader_issues.count()):
        return 0, n, 0
    by = {r["severity"]: r["n"] for r in found.groupBy("severity").agg(F.count("*").alias("n")).collect()}
    return records.count(), by.get("error", 0), by.get("warning", 0)


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The new rows and the old ones whose key is not among them."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def save(old: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """Upsert of records: generated_at and pipeline_version are filled where they are missing, saved_at is always set anew."""
    stamped = new.withColumn("generated_at", F.coalesce("generated_at", F.lit(now))).withColumn("pipeline_version", F.coalesce("pipeline_version", F.lit(fixed.RECORD_VERSION))).withColumn("saved_at", F.lit(now))
    return upsert(old, stamped)


def promote(target: DataFrame, source: DataFrame) -> tuple[DataFrame, int]:
    """Records of a target layer with all of a source layer put over them, none taken away, and how many those are; a source without records is an error."""
    n = source.count()
    if not n:
        raise ValueError("there are no records to promote")
    return upsert(target, source), n


def scratch(documents: DataFrame, base: DataFrame, override: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written copies of the documents and both layers, apart from the originals, for a dry run; they go when the program ends."""
    return cut(documents, "scratch-documents"), cut(base, "scratch-base"), cut(override, "scratch-override")


def preflight(records: DataFrame, documents: DataFrame, base: DataFrame, override: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is looked at before any summary is made: the issues of the records, with all that refers to documents as warnings, and the audit's counts."""
    return issues(records, documents, warn=("orphan", "title", "hash")), audit_counts(audit(documents, base, override))


def capped(decided: DataFrame, most: int, *order: str) -> DataFrame:
    """Documents with their decision, where only the first so many to be generated are and the others wait. (A cap on paid calls: the limit is the feature.)"""
    wanted = decided.where("decision = 'generate'").orderBy(*order).limit(most).select(*order, F.lit(True).alias("within"))
    rest = F.when((F.col("decision") == "generate") & F.col("within").isNull(), "waiting").otherwise(F.col("decision"))
    return decided.join(wanted, list(order), "left").withColumn("decision", rest).drop("within")


def capped_by_success(calls: DataFrame, most: int, *order: str) -> DataFrame:
    """Calls (the order's columns, ``outcome``: success, failure or stop) with ``state``: made, or waiting since enough calls have succeeded or one has said stop. (A cap on paid calls: the limit is the feature.)

    A call is made if fewer than ``most`` calls before it succeeded and none said
    stop.  Successes are counted in order: the calls are sorted by range, each
    partition counts its own, and the partitions' sums are added up, so no task
    holds more than a range.  Calls of equal order are taken as they come.
    """
    hit, stop = (F.col("outcome") == "success").cast("long"), (F.col("outcome") == "stop").cast("long")
    sorted_calls = calls.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(sorted_calls.select("*", F.spark_partition_id().alias("_block"), F.monotonically_increasing_id().alias("_at")), "calls")
    sums = placed.groupBy("_block").agg(F.sum(hit).alias("hits"), F.sum(stop).alias("stops"))  # one row a partition
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    start = sums.select("_block", F.coalesce(F.sum("hits").over(earlier), F.lit(0)).alias("_hits"), F.coalesce(F.sum("stops").over(earlier), F.lit(0)).alias("_stops"))
    within = W.partitionBy("_block").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, n: F.col(n) + F.coalesce(F.sum(c).over(within), F.lit(0))
    counted = placed.join(start, "_block").select("*", before(hit, "_hits").alias("_h"), before(stop, "_stops").alias("_s"))
    made = (F.col("_h") < most) & (F.col("_s") == 0)
    return counted.select(*calls.columns, F.when(made, "made").otherwise("waiting").alias("state"))


def repaired(documents: DataFrame, base: DataFrame, override: DataFrame, now: str) -> DataFrame:
    """Base records whose title or date is to be set right: current or pinned, without an override, and with another title than the document or no date."""
    current = base.where("readable").join(documents.select(*KEY, F.col("title").alias("doc_title"), "body_hash"), KEY).join(override, KEY, "left_anti")
    fresh = current.where(F.col("content_hash").isNull() | (F.col("content_hash") == F.col("body_hash")))
    dated = F.coalesce(F.trim("generated_at"), F.lit("")) != ""
    wrong = fresh.where(~F.trim("title").eqNullSafe(F.col("doc_title")) | ~dated)
    return wrong.withColumn("title", F.col("doc_title")).withColumn("generated_at", F.when(dated, F.col("generated_at")).otherwise(now)).select(*base.columns)


def fork(base: DataFrame, override: DataFrame, keys: DataFrame) -> DataFrame:
    """Override records for these keys from base: pinned, by hand; none where base has no readable record or an override is there."""
    picked = base.where("readable").join(keys, KEY, "left_semi").join(override, KEY, "left_anti")
    return picked.withColumn("content_hash", F.lit(None).cast("string")).withColumn("model", F.lit("manual-override"))


def legacy(documents: DataFrame, cache: DataFrame) -> DataFrame:
    """Documents without a usable record, with what an old cache has for exactly their body hash (hash, summary, when_to_use, related_topics)."""
    return documents.join(cache.withColumnRenamed("hash", "body_hash"), "body_hash", "left")


def decisions(looked_up: DataFrame, can_generate: Column) -> DataFrame:
    """What enrichment does with each document (frontmatter, body, status, legacy_hit): already, short, stored, stale, legacy, generate or skip."""
    already = F.col("frontmatter").contains("ai_summary:")
    short = F.size(text.words(F.col("body"))) < 15
    decision = (
        F.when(already, "already")
        .when(short, "short")
        .when(F.col("status") == "ok", "stored")
        .when((F.col("status") == "stale") & ~can_generate, "stale")
        .when(F.col("legacy_hit"), "legacy")
        .when(can_generate, "generate")
        .otherwise("skip")
    )
    return looked_up.withColumn("decision", decision)


def excluded(items: DataFrame, policy: DataFrame) -> DataFrame:
    """The items (source, identifier) that the policy does not name exactly; a match type in the policy is not looked at."""
    return items.join(policy.select("source", "identifier"), ["source", "identifier"], "left_anti")


def exclusion_reasons(items: DataFrame, policy: DataFrame) -> DataFrame:
    """Each item with the reason of the first policy row (by ``ordinal``) that names it; null if none does."""
    first = policy.groupBy("source", "identifier").agg(F.min_by(F.coalesce("reason", F.lit("no reason recorded")), "ordinal").alias("exclusion_reason"))
    return items.join(first, ["source", "identifier"], "left")
