"""The queries of this subpackage: op1 to op13 over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import alignment, centroids, chat, common, decontaminate, langid, licences, media, mixing, pii, simhash, simhash_sql, substrings, suffixes, urls


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(common.table(spark, sf_dir, "documents"), digest=True)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(common.table(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(common.table(spark, sf_dir, "documents"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(common.table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(common.table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated(common.table(spark, sf_dir, "documents"), digest=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(common.table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(common.table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(common.table(spark, sf_dir, "embeddings"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(spark, common.table(spark, sf_dir, "conversations"))


QUERIES = (
    op1_decontamination, op2_substring_dedup, op3_simhash, op4_licences, op5_media, op6_pii, op7_urls, op8_suffix_dedup, op9_mixing, op10_language,
    op11_alignment, op12_centroids, op13_chat,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """The statements of the queries that SQL can express over whole tables."""
    return {
        "op2_substring_dedup": substrings.oracle_sql(), "op3_simhash": simhash_sql.statement(), "op4_licences": licences.oracle_sql(), "op7_urls": urls.oracle_sql(), "op8_suffix_dedup": suffixes.oracle_sql(),
        "op12_centroids": centroids.oracle_sql(), "op13_chat": chat.oracle_sql(),
    }
