"""Every query of the library by name, with the DuckDB statement it is compared with.

The driver's tables stand in for the corpora the library was made for:
``documents`` are semantic documents (module: source, slug: doc_id), ``labels``
gives them summary records, ``conversations`` are discussion threads, ``pages``
are raw wiki pages and ``benchmark`` holds records without a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import fixed, mail, markdown, text, tokens
from siltstone.operators import layout, release, store, threads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- record stores -----------------------------------------------------------------------------------------------------
# Records: every label is a base record of its document; a bad label's hash is that of the upper-cased text (stale), a toxic
# one's is null (pinned) and has an override too, which is unreadable if the label is bad as well; benchmark items are orphans.


def semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("module"), F.col("doc_id").cast("string").alias("slug"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), text.body_hash(F.col("text")).alias("body_hash"))


def layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = labels.join(d.select("doc_id", F.col("source").alias("module"), "text"), "doc_id")
    own = F.when(F.col("toxic") == 1, F.lit(None)).when(F.col("quality") == 0, text.body_hash(F.upper("text"))).otherwise(text.body_hash(F.col("text")))
    base = joined.select("module", F.col("doc_id").cast("string").alias("slug"), own.alias("content_hash"), F.lit(True).alias("readable"))
    orphan = table(spark, sf_dir, "benchmark").select(F.lit("bench").alias("module"), F.col("item_id").cast("string").alias("slug"), text.body_hash(F.col("text")).alias("content_hash"), F.lit(True).alias("readable"))
    override = joined.where("toxic = 1").select("module", F.col("doc_id").cast("string").alias("slug"), F.lit(None).cast("string").alias("content_hash"), (F.col("quality") == 1).alias("readable"))
    return base.unionByName(orphan), override


STORE_SQL = """
docs AS (SELECT source AS module, CAST(doc_id AS VARCHAR) AS slug, left(sha256(text), 12) AS body_hash FROM documents),
joined AS (SELECT d.source AS module, CAST(d.doc_id AS VARCHAR) AS slug, d.text, quality, toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
base AS (SELECT module, slug, CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN left(sha256(upper(text)), 12) ELSE left(sha256(text), 12) END AS content_hash FROM joined
         UNION ALL SELECT 'bench', CAST(item_id AS VARCHAR), left(sha256(text), 12) FROM benchmark),
override AS (SELECT module, slug, quality = 1 AS readable FROM joined WHERE toxic = 1)
"""
AUDITED_SQL = f"""
WITH {STORE_SQL},
audited AS (
  SELECT d.module, d.slug,
         CASE WHEN o.slug IS NOT NULL THEN CASE WHEN o.readable THEN 'override_pinned' ELSE 'invalid_override' END
              WHEN b.slug IS NOT NULL THEN CASE WHEN b.content_hash IS NULL THEN 'base_pinned' WHEN b.content_hash = d.body_hash THEN 'base_current' ELSE 'base_stale' END
              ELSE 'missing' END AS status
  FROM docs d LEFT JOIN override o USING (module, slug) LEFT JOIN base b USING (module, slug)
  UNION ALL SELECT module, slug, 'orphan_base' FROM base b WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.module = b.module AND d.slug = b.slug)
  UNION ALL SELECT module, slug, 'orphan_override' FROM override b WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.module = b.module AND d.slug = b.slug)
)
"""


@query(AUDITED_SQL + "SELECT status, count(*) AS n FROM audited GROUP BY status")
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.audit_counts(store.audit(semantic(spark, sf_dir), *layers(spark, sf_dir)))


@query(AUDITED_SQL + "SELECT module, slug, status FROM audited WHERE status NOT LIKE '%current'")
def audit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.audit(semantic(spark, sf_dir), *layers(spark, sf_dir)).where(~F.col("status").like("%current"))


@query(
    AUDITED_SQL
    + """SELECT count(*) FILTER (WHERE status LIKE '%\\_current' ESCAPE '\\') AS current, count(*) FILTER (WHERE status LIKE '%\\_pinned' ESCAPE '\\') AS pinned,
         count(*) FILTER (WHERE status LIKE '%\\_stale' ESCAPE '\\') AS stale, count(*) FILTER (WHERE status = 'missing') AS missing,
         count(*) FILTER (WHERE status LIKE 'invalid%') AS invalid, count(*) FILTER (WHERE status LIKE 'orphan%') AS orphan FROM audited"""
)
def audit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.audit_totals(store.audit_counts(store.audit(semantic(spark, sf_dir), *layers(spark, sf_dir))))


@query(
    f"""WITH {STORE_SQL}
SELECT d.module, d.slug, CASE WHEN o.readable THEN 'override' WHEN b.slug IS NOT NULL THEN 'base' END AS store,
       CASE WHEN o.readable THEN 'ok' WHEN b.slug IS NULL THEN 'missing' WHEN b.content_hash IS NULL OR b.content_hash = d.body_hash THEN 'ok' ELSE 'stale' END AS status
FROM docs d LEFT JOIN override o USING (module, slug) LEFT JOIN base b USING (module, slug)"""
)
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.lookup(semantic(spark, sf_dir), *layers(spark, sf_dir)).select("module", "slug", "store", "status")


@query(f"WITH {STORE_SQL} SELECT 'base' AS store, count(*) AS n FROM base UNION ALL SELECT 'override', count(*) FROM override WHERE readable")
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.stats(*layers(spark, sf_dir))


@query(
    """WITH r AS (SELECT d.doc_id, l.quality, l.toxic, d.text FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
found AS (
  SELECT doc_id, quality, toxic, unnest([
    CASE WHEN toxic = 1 THEN 'ai_summary must be non-empty text' END,
    CASE WHEN quality = 0 THEN 'generated_at must be ISO 8601 text' END,
    CASE WHEN quality = 0 THEN 'content_hash does not match the document''s body' END]) AS message
  FROM r)
SELECT CAST(doc_id AS VARCHAR) AS slug, message, CASE WHEN message LIKE 'content_hash does%' THEN 'warning' ELSE 'error' END AS severity FROM found WHERE message IS NOT NULL"""
)
def record_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic labels' records have no summary; bad ones' have another hash and a date that is none."""
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    j = labels.join(d, "doc_id")
    slug, bad = F.col("doc_id").cast("string"), F.col("quality") == 0
    records = j.select(
        F.lit("base").alias("store"), F.col("source").alias("path_module"), slug.alias("path_slug"), F.col("source").alias("module"), slug.alias("slug"), F.concat(F.lit("Document "), slug).alias("title"),
        text.body_hash(F.when(bad, F.concat("text", F.lit("~"))).otherwise(F.col("text"))).alias("content_hash"), F.when(F.col("toxic") == 1, F.lit(" ")).otherwise("A summary.").alias("ai_summary"), F.lit("Always.").alias("ai_when_to_use"),
        F.array(F.lit("topic")).alias("ai_related_topics"), F.when(bad, "soon").otherwise("2026-03-09T00:00:00Z").alias("generated_at"), F.lit(None).cast("string").alias("saved_at"), F.lit("m").alias("model"), F.lit(fixed.RECORD_VERSION).alias("pipeline_version"),
        F.array(*[F.lit(f) for f in fixed.REQUIRED_FIELDS]).alias("present"),
    )
    return store.issues(records, semantic(spark, sf_dir), warn=("hash",)).select("slug", "message", "severity")


@query("SELECT doc_id, left(sha256(text), 8) AS raw_hash, left(sha256(text), 12) AS body_hash FROM documents")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.body_hash(F.col("text"), 8).alias("raw_hash"), text.body_hash(F.col("text")).alias("body_hash"))


@query("SELECT left(sha256(text), 12) AS body_hash, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def equal_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select("doc_id", text.body_hash(F.col("text")).alias("body_hash"))
    return hashed.groupBy("body_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(
    """WITH cache AS (SELECT DISTINCT left(sha256(text), 12) AS h FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1)
SELECT doc_id, h IS NOT NULL AS legacy_hit FROM documents LEFT JOIN cache ON left(sha256(text), 12) = h"""
)
def legacy_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old cache keyed by exactly the 12-digit hash: that of the well-labelled documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", text.body_hash(F.col("text")).alias("body_hash"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    cache = d.join(good, "doc_id", "left_semi").select(F.col("body_hash").alias("hash"), F.lit(True).alias("hit")).distinct()
    return store.legacy(d, cache).select("doc_id", F.coalesce("hit", F.lit(False)).alias("legacy_hit"))


#: An exclusion policy by exact (source, identifier); the match type is not looked at.
POLICY = (("src1", "en", "exact", "duplicate feed"), ("src2", "fr", "prefix", None), ("src3", "e", "prefix", "never matches: no prefix match"))


def _policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *p) for i, p in enumerate(POLICY)], "ordinal int, source string, identifier string, match_type string, reason string")


@query("SELECT doc_id, source, lang AS identifier FROM documents WHERE NOT ((source = 'src1' AND lang = 'en') OR (source = 'src2' AND lang = 'fr') OR (source = 'src3' AND lang = 'e'))")
def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("identifier"))
    return store.excluded(items, _policy(spark)).select("doc_id", "source", "identifier")


@query("SELECT doc_id, CASE WHEN source = 'src1' AND lang = 'en' THEN 'duplicate feed' WHEN source = 'src2' AND lang = 'fr' THEN 'no reason recorded' END AS exclusion_reason FROM documents")
def exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("identifier"))
    return store.exclusion_reasons(items, _policy(spark)).select("doc_id", "exclusion_reason")


@query("SELECT doc_id, CASE WHEN contains(text, 'ai_summary:') THEN 'already' WHEN len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) < 15 THEN 'short' WHEN quality = 1 THEN 'stored' WHEN quality = 0 THEN 'stale' ELSE 'skip' END AS decision FROM documents LEFT JOIN labels USING (doc_id)")
def enrichment_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a way to generate: good labels have a fresh record, bad ones a stale one."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    status = F.when(F.col("quality") == 1, "ok").when(F.col("quality") == 0, "stale").otherwise("missing")
    rows = d.select("doc_id", F.col("text").alias("frontmatter"), F.col("text").alias("body"), status.alias("status"), F.lit(False).alias("legacy_hit"))
    return store.decisions(rows, F.lit(False)).select("doc_id", "decision")


@query("SELECT doc_id, quality, toxic, 'new' AS origin FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, quality, toxic, 'old' FROM labels WHERE quality <> 0")
def record_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return store.upsert(labels.withColumn("origin", F.lit("old")), labels.where("quality = 0").withColumn("origin", F.lit("new")), ["doc_id"]).select("doc_id", "quality", "toxic", "origin")


# --- flags, categories, routing ----------------------------------------------------------------------------------------


def _re(p: str, column: str = "text") -> str:
    return f"regexp_matches({column}, {lit(p)}, 'i')"


def _word(p: str, column: str = "text") -> str:
    """As _re for ``\\b(...)\\b``: the oracle's word boundaries are ASCII only, these count letters with accents as letters."""
    return _re(f"(?:^|[^0-9A-Za-z_À-ɏ]){p}(?:$|[^0-9A-Za-z_À-ɏ])", column)


#: The invented texts have few problem words; threads of several turns and authors pass from here.
LOW = 25


KEYWORDS_SQL = "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_re(p)} THEN {lit(p)} END" for p in fixed.KEYWORDS) + "], lambda x: x IS NOT NULL))"
CATEGORIES_SQL = "list_filter([" + ", ".join(f"CASE WHEN {_re(p)} THEN {lit(k)} END" for k, p in fixed.CATEGORIES.items()) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, array_to_string({KEYWORDS_SQL}, ' ') AS keywords, coalesce(nullif(array_to_string({CATEGORIES_SQL}, ' '), ''), 'uncategorized') AS categories FROM documents")
def text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.keywords(t), " ").alias("keywords"), F.array_join(text.categories(t), " ").alias("categories"))


@query(f"WITH c AS (SELECT coalesce(({CATEGORIES_SQL})[1], 'uncategorized') AS category, text FROM conversations) SELECT category, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM c GROUP BY category")
def primary_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(text.primary_category(text.categories(F.col("text"))).alias("category"), "text")
    return c.groupBy("category").agg(F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))


SIGNALS_SQL = ", ".join((f"regexp_matches(text, {lit(p)})" if k == "has_code_block" else _re(p)) + f" AS {k}" for k, p in fixed.SIGNALS.items())


@query(f"SELECT doc_id, {SIGNALS_SQL} FROM documents")
def structural_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.signals(F.col("text")).alias("s")).select("doc_id", "s.*")


@query(
    f"""SELECT conv_id, turn, CASE WHEN {_re(fixed.BOT_SENDER, "role")} THEN 'dropped' WHEN {_re("[[]VOTE]", "subject")} OR {_word("(?:CI|buildbot|patchwork)", "subject")} THEN 'sidelined'
  WHEN turn = 0 AND (length(regexp_replace(subject || ' ' || text, '[^A-Za-z]', '', 'g')) < 20 OR (len({KEYWORDS_SQL}) = 0 AND length(text) < 40)) THEN 'dropped' ELSE 'primary' END AS disposition
FROM (SELECT *, split_part(text, chr(10), 1) AS subject FROM conversations)"""
)
def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages: the role sends, the first line is the subject, every turn but the first replies."""
    c = table(spark, sf_dir, "conversations")
    t = F.col("text")
    reply = F.when(F.col("turn") > 0, F.lit("<turn>"))
    return c.select("conv_id", "turn", text.disposition(F.col("role"), F.substring_index(t, "\n", 1), t, text.keywords(t), reply).alias("disposition"))


@query("SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters FROM documents")
def text_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.filter(F.split(t, r"\s+"), lambda x: x != "")).cast("long").alias("n_words"), text.letters(t).cast("long").alias("n_letters"))


@query(
    """WITH e AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-f0-9]{7,12}') AS hits, text FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9_À-ɏ]+'), lambda x: regexp_full_match(x, '[a-f0-9]{7,12}')))), ' ') AS commits FROM e"""
)
def commit_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.commits(F.col("text")), " ").alias("commits"))


#: A sentence's end gets a mark, so that no look-around is needed: the capital or digit behind the white space is put back.
WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SENTENCES_SQL = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(replace({c}, chr(13), ''), '\n{{2,}}', '.' || chr(10), 'g'), '([.!?])\s+([A-Z0-9])', '\1' || chr(31) || '\2', 'g'), chr(31)), lambda x: trim(x, " + WHITE + r")), lambda x: x <> '')"


@query(f"WITH s AS (SELECT doc_id, {SENTENCES_SQL.format(c='text')} AS s FROM documents) SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, s[1] AS first FROM s")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences end before white space and a capital or digit."""
    s = text.sentences(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n_sentences"), F.try_element_at(s, F.lit(1)).alias("first"))


# --- threads -----------------------------------------------------------------------------------------------------------


def as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as primary messages of the thread of their conversation."""
    c = table(spark, sf_dir, "conversations")
    t = F.col("text")
    ident = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    return c.select(
        ident(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, ident(F.col("turn") - 1)).alias("parent"), F.col("turn").alias("ordinal"), F.col("conv_id").cast("string").alias("root"), F.col("role").alias("sender"),
        F.substring_index(t, "\n", 1).alias("subject"), t.alias("body"), t.alias("body_no_diff"), F.lit(None).cast("string").alias("date_iso"), F.lit("conversations").alias("source_file"), F.lit("").alias("archive_url"), F.col("turn").alias("byte_offset"),
        text.file_references(t).alias("files"), text.commits(t).alias("commits"), text.categories(t).alias("categories"), text.signals(t).alias("signals"),
    )


THREADS_SQL = f"""
turns AS (SELECT *, split_part(text, chr(10), 1) AS subject FROM conversations),
rolled AS (
  SELECT CAST(conv_id AS VARCHAR) AS thread_id, arg_min(subject, turn) AS subject, count(*) AS message_count, count(DISTINCT role) FILTER (WHERE role <> '') AS author_count,
    {_re(fixed.PROBLEM, "string_agg(text, chr(10) ORDER BY turn)")} AS problem, {_re(fixed.CORRECTION, "string_agg(text, chr(10) ORDER BY turn)")} AS correction, {_word("NACK?", "string_agg(text, chr(10) ORDER BY turn)")} AS nack,
    bool_or({_re(fixed.FILE_REFERENCE)}) OR bool_or(len(list_filter(string_split_regex(lower(text), '[^a-z0-9_À-ɏ]+'), lambda x: regexp_full_match(x, '[a-f0-9]{{7,12}}'))) > 0) AS refs,
    bool_or({_re(fixed.SIGNALS["has_compiler_error"])}) AS compiler_error, bool_or({_re(fixed.SIGNALS["has_stack_trace"])}) AS stack_trace, bool_or({_re(fixed.SIGNALS["has_build_error"])}) AS build_error,
    bool_or(regexp_matches(text, {lit(fixed.SIGNALS["has_code_block"])})) AS code_block, bool_or({_re(fixed.SIGNALS["has_reference_urls"])}) AS urls, bool_or({_re(fixed.SIGNALS["has_patch_revision"])}) AS revision
  FROM turns GROUP BY conv_id),
scored AS (
  SELECT thread_id, subject, message_count, author_count, CAST(greatest(0, least(100,
    CASE WHEN problem THEN 30 ELSE 0 END + CASE WHEN correction THEN 30 ELSE 0 END + CASE WHEN author_count >= 2 THEN 15 ELSE 0 END + CASE WHEN refs THEN 10 ELSE 0 END
    + CASE WHEN message_count >= 2 THEN 10 ELSE 0 END + CASE WHEN {_re(fixed.SIGNALS["has_patch_revision"], "subject")} THEN 5 ELSE 0 END + CASE WHEN nack THEN 5 ELSE 0 END
    + CASE WHEN compiler_error THEN 25 ELSE 0 END + CASE WHEN stack_trace THEN 20 ELSE 0 END + CASE WHEN build_error THEN 20 ELSE 0 END
    + CASE WHEN code_block AND author_count >= 2 THEN 10 ELSE 0 END + CASE WHEN urls THEN 5 ELSE 0 END + CASE WHEN revision THEN 10 ELSE 0 END
    - CASE WHEN {_re("bump to", "subject")} AND author_count < 2 THEN 20 ELSE 0 END)) AS INTEGER) AS score_cents
  FROM rolled)
"""


@query(f"WITH {THREADS_SQL} SELECT thread_id, subject, message_count, author_count, score_cents, score_cents / 100.0 AS score FROM scored")
def thread_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.rollup(as_messages(spark, sf_dir)).select("thread_id", "subject", "message_count", "author_count", "score_cents", "score")


@query(f"WITH {THREADS_SQL} SELECT thread_id, score_cents FROM scored WHERE score_cents >= {fixed.PASSING}")
def passing_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads at or over the threshold that lessons are made from."""
    return threads.passing(threads.rollup(as_messages(spark, sf_dir))).select("thread_id", "score_cents")


@query(f"WITH {THREADS_SQL} SELECT printf('lesson-%04d', row_number() OVER (ORDER BY score_cents DESC, lower(subject), thread_id)) AS lesson_id, thread_id, score_cents FROM scored WHERE score_cents >= {LOW}")
def lesson_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = threads.passing(threads.rollup(as_messages(spark, sf_dir)), LOW)
    return threads.numbered(kept).select("lesson_id", "thread_id", "score_cents")


@query(
    """WITH RECURSIVE m AS (SELECT conv_id || '-' || turn AS id, CASE WHEN turn > 0 THEN conv_id || '-' || (turn - 1) END AS parent FROM conversations),
climb AS (SELECT id, id AS node FROM m UNION ALL SELECT c.id, p.id FROM climb c JOIN m x ON c.node = x.id JOIN m p ON x.parent = p.id)
SELECT c.id, c.node AS root FROM climb c JOIN m ON c.node = m.id WHERE m.parent IS NULL OR m.parent NOT IN (SELECT id FROM m)"""
)
def thread_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.roots(as_messages(spark, sf_dir).select("id", "parent", "ordinal"))


LESSONS_SQL = f"""{THREADS_SQL}, kept AS (SELECT * FROM scored WHERE score_cents >= {LOW}),
numbers AS (SELECT thread_id, printf('lesson-%04d', row_number() OVER (ORDER BY score_cents DESC, lower(subject), thread_id)) AS lesson_id FROM kept),
cut AS (SELECT CAST(conv_id AS VARCHAR) AS thread_id, turn, role, text, {SENTENCES_SQL.format(c="text")} AS s FROM conversations WHERE CAST(conv_id AS VARCHAR) IN (SELECT thread_id FROM kept)),
hits AS (SELECT *, list_position(list_transform(s, lambda x: {_re(fixed.PROBLEM, "x")}), true) AS p, list_position(list_transform(s, lambda x: {_re(fixed.CORRECTION, "x")}), true) AS f FROM cut),
shown AS (SELECT *, CASE WHEN p > 0 THEN array_to_string(s[greatest(1, p - 1) : CASE WHEN p = 1 THEN 3 ELSE p + 2 END], ' ') END AS problem, CASE WHEN f > 0 THEN array_to_string(s[greatest(1, f - 1) : CASE WHEN f = 1 THEN 3 ELSE f + 2 END], ' ') END AS fix FROM hits),
first_problem AS (SELECT thread_id, arg_min(problem, turn) AS problem, arg_min(role, turn) AS author FROM shown WHERE problem IS NOT NULL GROUP BY thread_id),
others AS (SELECT s.* FROM shown s LEFT JOIN first_problem a USING (thread_id) WHERE coalesce(author, '') = '' OR role <> author),
asked AS (SELECT * FROM others UNION ALL SELECT s.* FROM shown s WHERE thread_id NOT IN (SELECT thread_id FROM others)),
first_fix AS (SELECT thread_id, arg_min(fix, turn) AS fix FROM asked WHERE fix IS NOT NULL GROUP BY thread_id),
gathered AS (SELECT CAST(conv_id AS VARCHAR) AS thread_id, bool_or({_re(fixed.FILE_REFERENCE)}) AS files, flatten(list(CASE WHEN len({CATEGORIES_SQL}) > 0 THEN {CATEGORIES_SQL} ELSE ['uncategorized'] END ORDER BY turn)) AS every FROM conversations GROUP BY conv_id),
marks AS (SELECT thread_id, files, list_filter(every, lambda x, i: list_position(every, x) = i) AS categories FROM gathered),
lessons AS (SELECT lesson_id, k.thread_id, score_cents, score_cents / 100.0 AS score, problem, fix, coalesce(files, false) AS files, categories, regexp_replace(subject, '^(?:Re:\\s*)*(?:\\[[^\\]]+\\]\\s*)+', '') AS bare
  FROM kept k JOIN numbers USING (thread_id) LEFT JOIN first_problem USING (thread_id) LEFT JOIN first_fix USING (thread_id) LEFT JOIN marks USING (thread_id)),
titled AS (SELECT *, CASE WHEN problem IS NOT NULL AND fix IS NOT NULL THEN trim(bare) || ': mistake and correction' WHEN problem IS NOT NULL THEN trim(bare) || ': recurring problem pattern' WHEN trim(bare) <> '' THEN trim(bare) ELSE thread_id END AS title,
  CASE WHEN problem IS NOT NULL AND fix IS NOT NULL THEN 'complete' WHEN problem IS NOT NULL AND files THEN 'searchable' WHEN problem IS NOT NULL THEN 'problem-only' ELSE 'fragmentary' END AS level FROM lessons)
"""


@query(f"WITH {LESSONS_SQL} SELECT lesson_id, thread_id, title, score, array_to_string(categories, ' ') AS categories, problem, fix, level FROM titled")
def lesson_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = as_messages(spark, sf_dir)
    found = threads.lessons(m, threads.passing(threads.rollup(m), LOW))
    return found.select("lesson_id", "thread_id", "title", "score", F.array_join("categories", " ").alias("categories"), F.col("problem.snippet").alias("problem"), F.col("fix.snippet").alias("fix"), F.col("completeness.level").alias("level"))


@query(
    f"""WITH {LESSONS_SQL}, each AS (SELECT categories[1] AS category, score_cents, title, lesson_id, list_concat(categories, list_filter(regexp_extract_all(lower(coalesce(problem, '')), '[A-Za-z][A-Za-z0-9_.:-]{{2,}}'), lambda x: x NOT IN ({", ".join(map(lit, fixed.STOP_WORDS))}))) AS s FROM titled),
flat AS (SELECT category, score_cents, lower(title) AS low, lesson_id, unnest(s) AS signal, generate_subscripts(s, 1) AS at_ FROM each),
counted AS (SELECT category, signal, count(*) AS n, min((-score_cents, low, lesson_id, at_)) AS seen FROM flat GROUP BY category, signal),
ranked AS (SELECT category, signal, n, CAST(row_number() OVER (PARTITION BY category ORDER BY n DESC, seen) AS INTEGER) AS rank FROM counted)
SELECT * FROM ranked WHERE rank <= 12"""
)
def common_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = as_messages(spark, sf_dir)
    return threads.common_signals(threads.lessons(m, threads.passing(threads.rollup(m), LOW)))


@query(f"WITH {LESSONS_SQL} SELECT DISTINCT unnest(categories) AS category FROM titled")
def lesson_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = as_messages(spark, sf_dir)
    return threads.distinct_categories(threads.passing(threads.rollup(m), LOW))


@query(f"WITH {LESSONS_SQL} SELECT level, count(*) AS n FROM titled GROUP BY level")
def lesson_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = as_messages(spark, sf_dir)
    return threads.completeness_counts(threads.lessons(m, threads.passing(threads.rollup(m), LOW)))


@query(f"WITH {THREADS_SQL} SELECT CAST(least(score_cents, 99) // 10 * 10 AS INTEGER) AS low, count(*) AS n FROM scored GROUP BY 1")
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.score_bands(threads.rollup(as_messages(spark, sf_dir)))


@query(
    """WITH t AS (SELECT d.source, unnest(regexp_extract_all(lower(text), '[A-Za-z][A-Za-z0-9_.:-]{2,}')) AS token FROM documents d),
c AS (SELECT source, token, count(*) AS n FROM t WHERE token NOT IN ("""
    + ", ".join(map(lit, fixed.STOP_WORDS))
    + """) GROUP BY source, token), r AS (SELECT source, token, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, token) AS rank FROM c)
SELECT source, token, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12"""
)
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve most frequent report tokens of every source. (A top-k report.)"""
    from pyspark.sql import Window as W

    each = table(spark, sf_dir, "documents").select("source", F.explode(text.report_tokens(F.col("text"))).alias("token"))
    counted = each.groupBy("source", "token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("source").orderBy(F.desc("n"), "token"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= 12)


@query(
    f"""WITH t AS (SELECT *, conv_id || '-' || turn AS id, trim(text, {WHITE}) AS body FROM conversations), k AS (SELECT *, len({KEYWORDS_SQL.replace("(text,", "(chr(10) || body,")}) AS n FROM t)
SELECT '<' || id || '@x>' AS message_id, CASE WHEN turn > 0 THEN '<' || conv_id || '-' || (turn - 1) || '@x>' END AS in_reply_to, role || '@example.com' AS from_addr, '2026-03-09T10:00:00+01:00' AS date_iso, sha256(body) AS body, CAST(n AS INTEGER) AS n_keywords,
  CASE WHEN turn = 0 AND (length(regexp_replace(body, '[^A-Za-z]', '', 'g')) < 20 OR (n = 0 AND length(body) < 40)) THEN 'dropped' ELSE 'primary' END AS disposition FROM k"""
)
def mail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as mail messages and parsed again."""
    m = as_messages(spark, sf_dir)
    raw = F.concat_ws("\n", F.concat(F.lit("Message-ID: <"), "id", F.lit("@x>")), F.concat(F.lit("In-Reply-To: <"), "parent", F.lit("@x>")), F.concat(F.lit("From: "), "sender", F.lit(" at example.com ("), "sender", F.lit(")")), F.lit("Date: Mon, 09 Mar 2026 10:00:00 +0100"), F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit"), F.lit("Subject:\n"), F.col("body"))
    found = mail.records(m.select("source_file", "byte_offset", F.lit("From x").alias("from_line"), raw.cast("binary").alias("message")))
    return found.select("message_id", "in_reply_to", "from_addr", "date_iso", F.sha2("body_for_scoring", 256).alias("body"), F.size("keyword_matches").alias("n_keywords"), "disposition")


# --- packing, drift, links, plans --------------------------------------------------------------------------------------

BUDGET = 20_000


@query(
    f"""WITH RECURSIVE d AS (SELECT source AS module, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
walk AS (
  SELECT module, rn, doc_id, n_chars, n_chars AS used, 1 AS part FROM d WHERE rn = 1
  UNION ALL
  SELECT d.module, d.rn, d.doc_id, d.n_chars, CASE WHEN w.used + d.n_chars > {BUDGET} THEN d.n_chars ELSE w.used + d.n_chars END, CASE WHEN w.used + d.n_chars > {BUDGET} THEN w.part + 1 ELSE w.part END
  FROM walk w JOIN d ON d.module = w.module AND d.rn = w.rn + 1)
SELECT module, part, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS tokens, printf('bundled-reference.part-%02d.md', part) AS file FROM walk GROUP BY module, part"""
)
def shard_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("module"), F.col("doc_id").alias("file"), F.col("n_chars").alias("token_count"))
    return layout.part_totals(layout.shards(d, BUDGET))


@query("SELECT source AS module, CAST(sum(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS tokens, count(*) AS n_docs FROM documents GROUP BY source")
def module_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).cast("long")
    return table(spark, sf_dir, "documents").groupBy(F.col("source").alias("module")).agg(F.sum(n).alias("tokens"), F.count("*").alias("n_docs"))


@query()
def bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by a public byte-pair vocabulary; SQL has none."""
    return tokens.totals(table(spark, sf_dir, "documents").select(F.col("source").alias("module"), "text"), "module", "/opt/tokenizers/byte_bpe_50k.tiktoken")


SNAPSHOT_SQL = """
old AS (SELECT d.doc_id AS symbol, CASE WHEN quality = 0 THEN left(sha256(text || '~'), 12) ELSE left(sha256(text), 12) END AS signature FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
new AS (SELECT d.doc_id AS symbol, left(sha256(text), 12) AS signature FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) = 0)
"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old: the labelled documents, bad ones with another signature; new: all that are not toxic."""
    j = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    t = F.col("text")
    old = j.where("quality is not null").select(F.col("doc_id").alias("symbol"), text.body_hash(F.when(F.col("quality") == 0, F.concat(t, F.lit("~"))).otherwise(t)).alias("signature"))
    return old, j.where(F.coalesce("toxic", F.lit(0)) == 0).select(F.col("doc_id").alias("symbol"), text.body_hash(t).alias("signature"))


@query(
    f"""WITH {SNAPSHOT_SQL} SELECT coalesce(o.symbol, n.symbol) AS symbol, CASE WHEN o.symbol IS NULL THEN 'added' WHEN n.symbol IS NULL THEN 'removed' ELSE 'changed' END AS change, o.signature AS before, n.signature AS after
FROM old o FULL OUTER JOIN new n ON o.symbol = n.symbol WHERE o.symbol IS NULL OR n.symbol IS NULL OR o.signature <> n.signature"""
)
def api_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.drift(*snapshots(spark, sf_dir))


@query(
    """WITH old AS (SELECT DISTINCT split_part(url, '/', 3) AS module FROM pages WHERE url LIKE 'https%'), new AS (SELECT DISTINCT split_part(url, '/', 3) AS module FROM pages WHERE url NOT LIKE '%#top')
SELECT coalesce(o.module, n.module) AS module, CASE WHEN o.module IS NULL THEN 'added' ELSE 'removed' END AS change FROM old o FULL OUTER JOIN new n ON o.module = n.module WHERE o.module IS NULL OR n.module IS NULL"""
)
def module_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts as modules; baseline: those with a page over https; now: those with a page whose url does not end in #top."""
    p = table(spark, sf_dir, "pages").select("url", F.split("url", "/")[2].alias("module"))
    return layout.module_drift(p.where(~F.col("url").like("%#top")).select("module").distinct(), p.where(F.col("url").like("https%")).select("module").distinct())


@query("SELECT DISTINCT source AS module FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'es' AND n_chars > 12000)")
def rerun_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun that only brings the sources of long Spanish documents loses the others."""
    d = table(spark, sf_dir, "documents")
    return layout.missing_on_rerun(d.select(F.col("source").alias("module")).distinct(), d.where("lang = 'es' and n_chars > 12000").select(F.col("source").alias("module")).distinct())


@query(
    """WITH l AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS target FROM pages)
SELECT page_id, target FROM l WHERE NOT regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') AND target NOT IN (SELECT '/' || lang FROM documents)"""
)
def dead_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages within their site that lead to no language's root."""
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))).alias("target"))
    there = table(spark, sf_dir, "documents").select(F.concat(F.lit("/"), "lang").alias("target")).where("target is not null").distinct()
    return p.where(~F.col("target").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")).join(there, "target", "left_anti").select("page_id", "target")


def _census_sql() -> str:
    c = ", ".join(f"count(*) FILTER (WHERE regexp_matches(html, {lit(p)})) AS {k}_files, CAST(coalesce(sum(len(regexp_extract_all(html, {lit(p)}))), 0) AS BIGINT) AS {k}_count" for k, p in markdown.ARTIFACTS.items())
    return f"WITH r AS (SELECT count(*) AS files, {c}, CAST(0 AS BIGINT) AS duplicate_headings FROM pages) SELECT *, CASE WHEN files < {markdown.LEAST_PAGES} OR {' OR '.join(f'{k}_files > 0' for k in markdown.ARTIFACTS)} THEN 'abnormal' ELSE 'normal' END AS status FROM r"


@query(_census_sql())
def artifact_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.artifact_census(table(spark, sf_dir, "pages"), "html")


@query(
    """SELECT doc_id, '# Page ' || doc_id || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '## Other' || chr(10) || chr(10) END || trim(text) || chr(10) || chr(10) || '| Key | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| lang | ' || lang || '; ' || source || ' |' || chr(10)
  || '| size | `' || n_chars || '` |' || chr(10) || chr(10) || 'It is **' || doc_id || '**[^1].' || chr(10) || chr(10) || '[^1]: Note ' || doc_id || '.' || chr(10) AS content FROM documents"""
)
def cleaned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw wiki pages: marks around their text, a title said again in every second one, a table, a footnote."""
    n = F.col("doc_id").cast("string")
    again = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("## PAGE "), n)).otherwise("## Other")
    cells = F.concat(F.lit("<table><tr><th>Key</th><th>Value</th></tr><tr><td>lang</td><td>"), "lang", F.lit("<br />"), "source", F.lit("</td></tr><tr><td>size</td><td><code>"), F.col("n_chars").cast("string"), F.lit("</code></td></tr></table>"))
    note = F.concat(F.lit('It is <u>'), n, F.lit('</u><a href="#fn1" class="footnote-ref" id="fnref1"><sup>1</sup></a>.\n\n<aside id="footnotes" class="footnotes"><ol><li id="fn1">Note '), n, F.lit('. <a class="footnote-back" href="#fnref1">x</a></li></ol></aside>\n'))
    raw = F.concat(F.lit("# Page "), n, F.lit("\n\n"), again, F.lit("\n\n\\<WRAP round tip\\>"), "text", F.lit("\\</WRAP\\>\n\n"), cells, F.lit("\n\n"), note)
    return table(spark, sf_dir, "documents").select("doc_id", markdown.cleaned(F.concat(F.lit("Page "), n), raw).alias("content"))


@query(
    """WITH s AS (SELECT doc_id AS path, n_chars AS size FROM documents WHERE lang <> 'fr'), t AS (SELECT d.doc_id AS path, CASE WHEN quality = 0 THEN n_chars + 1 ELSE n_chars END AS size FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT CAST(coalesce(s.path, t.path) AS VARCHAR) AS path, CASE WHEN t.path IS NULL OR s.size <> t.size THEN 'copy' WHEN s.path IS NULL THEN 'delete' ELSE 'skip' END AS action FROM s FULL OUTER JOIN t ON s.path = t.path"""
)
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tree: documents that are not French; target: the labelled ones, bad ones a byte longer."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "doc_id", F.col("n_chars").alias("size"), "lang", F.lit(0.0).alias("mtime"), F.lit(False).alias("is_link"))
    t = d.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("size", F.col("size") + F.when(F.col("quality") == 0, 1).otherwise(0))
    return layout.sync_plan(d.where("lang <> 'fr'"), t, delete_extra=True)


@query("SELECT page_id, host, CASE WHEN regexp_matches(host, '^(?:[^.]+\\.)*example\\.(?:com|org)$') THEN 'kept' ELSE 'off-site' END AS verdict FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)")
def site_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host")).select("page_id", "host", F.when(F.col("host").rlike(r"^(?:[^.]+\.)*example\.(?:com|org)$"), "kept").otherwise("off-site").alias("verdict"))


def _first(*options: Column) -> Column:
    return F.coalesce(*[F.when(F.trim(o) != "", F.trim(o)) for o in options])


@query("SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'Routing ' || doc_id END, CASE WHEN toxic = 0 THEN 'Summary ' || doc_id END, CASE WHEN lang = 'en' THEN 'Description ' || doc_id END) AS short FROM documents LEFT JOIN labels USING (doc_id)")
def short_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    named = lambda cond, name: F.when(cond, F.concat(F.lit(name + " "), F.col("doc_id").cast("string")))
    return d.select("doc_id", text.short_description(named(F.col("quality") == 1, "Routing"), named(F.col("toxic") == 0, "Summary"), named(F.col("lang") == "en", "Description")).alias("short"))


@query("SELECT doc_id, CASE WHEN source <> 'src0' THEN 'https://example.org/' || source || '/blob/' || left(sha256(text), 12) || '/docs/' || doc_id || '.md' END AS url FROM documents")
def provenance_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    commit = F.when(F.col("source") != "src0", text.body_hash(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", text.source_url(F.concat(F.lit("https://example.org/"), "source"), commit, F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".md"))).alias("url"))


@query(
    """SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value >= 50) AS passed, CAST(floor(1000.0 * count(*) FILTER (WHERE value >= 50) / count(*)) AS BIGINT) AS pass_permille FROM events GROUP BY event_type"""
)
def competence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by domain: events as scenarios, passed at a value of 50 or more."""
    ok = F.count_if(F.col("value") >= 50)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), ok.alias("passed"), F.floor(F.lit(1000.0) * ok / F.count("*")).alias("pass_permille"))


# --- release -----------------------------------------------------------------------------------------------------------
# Registry: benchmark items name their first word as a symbol; items with an even number of characters are deprecated.

SYMBOLS_SQL = "sym AS (SELECT regexp_extract(text, '[A-Za-z]+') AS symbol, bool_or(length(text) % 2 = 0) AS deprecated FROM benchmark GROUP BY 1)"


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "[A-Za-z]+", 0).alias("symbol"), (F.length("text") % 2 == 0).alias("even"))
    return b.groupBy("symbol").agg(F.bool_or("even").alias("deprecated"))


WORDS_SQL = "unnest(list_distinct(regexp_extract_all(regexp_replace(text, '`[^`\n]*`', ' ', 'g'), '[A-Za-z_$][0-9A-Za-z_$]*(?:\\.[A-Za-z_$][0-9A-Za-z_$]*)*')))".replace("\\\\", "\\")


@query(f"WITH {SYMBOLS_SQL}, w AS (SELECT doc_id, {WORDS_SQL} AS symbol FROM documents) SELECT symbol, deprecated, count(*) AS n_docs, min(doc_id) AS first_doc FROM w JOIN sym USING (symbol) GROUP BY symbol, deprecated")
def symbol_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return release.mentions(docs, _symbols(spark, sf_dir)).groupBy("symbol", "deprecated").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(f"WITH {SYMBOLS_SQL}, w AS (SELECT doc_id, {WORDS_SQL} AS symbol FROM documents) SELECT doc_id, count(*) > 0 AS warned, string_agg(symbol, ', ' ORDER BY symbol) AS deprecated FROM w JOIN sym USING (symbol) WHERE deprecated GROUP BY doc_id")
def deprecated_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    warned = release.warn_of_deprecated(docs, _symbols(spark, sf_dir))
    listed = F.regexp_extract("content", r"\A> \[!WARNING\]\n> Deprecated: ([^\n]*)\n", 1)
    return warned.select(F.col("path").alias("doc_id"), (listed != "").alias("warned"), listed.alias("deprecated")).where("warned")


#: Of each document the known words, each linked where it first stands.
LINKED_SQL = f"""WITH {SYMBOLS_SQL}, w AS (SELECT doc_id, text, {WORDS_SQL} AS symbol FROM documents), known AS (SELECT doc_id, list(symbol ORDER BY symbol) AS symbols FROM w JOIN sym USING (symbol) GROUP BY doc_id)
SELECT CAST(d.doc_id AS VARCHAR) AS path, CASE WHEN symbols IS NULL THEN text ELSE list_reduce(symbols, lambda acc, s: regexp_replace(acc, '(^|[^0-9A-Za-z_.À-ɏ])' || s || '($|[^0-9A-Za-z_À-ɏ])', '\\1[' || s || '](symbols/' || s || ')\\2'), text) END AS content FROM documents d LEFT JOIN known k ON d.doc_id = k.doc_id"""


@query(LINKED_SQL)
def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with links (the tables have no code, tags or links in which a word would be left alone)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    registry = _symbols(spark, sf_dir).select("symbol", F.concat(F.lit("symbols/"), "symbol").alias("target"))
    return release.link(docs, registry).select("path", "content")


@query(
    """WITH l AS (SELECT source AS module, n_chars, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS place, doc_id || '.md' AS file FROM documents)
SELECT module, CAST(sum(n_chars) AS BIGINT) AS tokens, '# ' || module || ' module' || chr(10) || '> **Total Context:** ~' || CAST(sum(n_chars) AS BIGINT) || ' tokens' || chr(10) || chr(10)
  || string_agg('- [' || file || '](./chunked-reference/' || file || ') (~' || n_chars || ' tokens)', chr(10) ORDER BY place, file) AS index FROM l GROUP BY module"""
)
def module_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents have high priority, French medium, German low, the rest none."""
    priority = F.when(F.col("lang") == "en", "high").when(F.col("lang") == "fr", "medium").when(F.col("lang") == "de", "low")
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("module"), F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("file"), F.lit(None).cast("string").alias("short"), F.col("n_chars").alias("token_count"), priority.alias("routing_priority"))
    return release.module_index(docs)


@query(
    """WITH e AS (SELECT DISTINCT event_type AS module, 'f' || (user_id % 7) AS name FROM events)
SELECT module, 'declare module "' || module || '" {' || chr(10) || string_agg('    export function ' || name || '(event: any, options?: any): any;', chr(10) ORDER BY name) || chr(10) || '}' AS source FROM e GROUP BY module"""
)
def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as modules; users as functions of an event and options."""
    parameter = lambda n, o: F.struct(F.lit(n).alias("name"), F.lit(o).alias("optional"))
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("module"), F.concat(F.lit("f"), (F.col("user_id") % 7).cast("string")).alias("name"))
    return release.declarations(e.withColumn("parameters", F.array(parameter("event", False), parameter("options", True))))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
