"""Queries over files: trees written from the driver's tables into the shared folder, scanned again by the sources.

A tree is written once for a session and folder of tables.  Documents with
``doc_id % 40 = 39`` have no header, those with 38 one that is no mapping.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import lineage
from siltstone.functions import fixed, mail, markdown, text
from siltstone.operators import layout, release, store, threads
from siltstone.plans.catalogue import KEYWORDS_SQL, LESSONS_SQL, LOW, STORE_SQL, as_messages, layers, lit, query, semantic, table
from siltstone.sources import corpus, extractors, packages, runs, sinks
from siltstone.streaming import crawl

_trees: dict[tuple[str, str, str], str] = {}


def tree(spark: SparkSession, sf_dir: str, name: str, files) -> str:
    """The folder into which ``files()`` (path, content) were written."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _trees:
        root = f"{lineage.shared_dir(spark)}/tree-{name}-{uuid.uuid4().hex}"
        runs.write_tree(files(), root)
        lineage._written.append((spark, root))
        _trees[key] = root
    return _trees[key]


def name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def number(c: str) -> Column:
    return F.col(c).cast("string")


# --- documents and records ---------------------------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    header = F.concat(F.lit("---\ntitle: Document "), number("doc_id"), F.lit("\nmodule: "), "source", F.lit("\ntoken_count: "), number("n_chars"), F.lit("\n---\n"))
    kind = F.col("doc_id") % 40
    content = F.when(kind == 39, F.col("text")).when(kind == 38, F.concat(F.lit("---\n- a\n- b\n---\n"), "text")).otherwise(F.concat(header, "text"))
    return d.select(F.concat("source", F.lit("/"), number("doc_id"), F.lit(".md")).alias("path"), content.alias("content"))


def l2(spark: SparkSession, sf_dir: str) -> str:
    return tree(spark, sf_dir, "l2", lambda: _pages(spark, sf_dir))


@query("SELECT source AS module, CAST(doc_id AS VARCHAR) AS slug, 'Document ' || doc_id AS title, left(sha256(text), 12) AS body_hash, n_chars AS token_count, sha256(text) AS body FROM documents WHERE doc_id % 40 < 38")
def scanned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.documents(spark, l2(spark, sf_dir))[0].select("module", "slug", "title", "body_hash", "token_count", F.sha2("body", 256).alias("body"))


@query("SELECT doc_id || '.md' AS file, CASE doc_id % 40 WHEN 39 THEN 'no frontmatter' ELSE 'frontmatter is no mapping' END AS problem FROM documents WHERE doc_id % 40 >= 38")
def document_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.documents(spark, l2(spark, sf_dir))[1].select(name_of(F.col("path")).alias("file"), "problem")


@query("SELECT source AS module, CAST(doc_id AS VARCHAR) AS slug FROM documents")
def corpus_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.targets(spark, l2(spark, sf_dir)).select("module", "slug")


@query("SELECT source || '/' || doc_id || '.md' AS path, CASE WHEN doc_id % 40 = 39 THEN NULL WHEN doc_id % 40 = 38 THEN '- a' || chr(10) || '- b' ELSE 'title: Document ' || doc_id || chr(10) || 'module: ' || source || chr(10) || 'token_count: ' || n_chars END AS frontmatter, CASE WHEN doc_id % 40 < 39 THEN sha256(text) END AS body FROM documents")
def split_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and body of every page, by its path below the tree."""
    root = l2(spark, sf_dir)
    files = corpus.whole_files(spark, root, "*.md")
    return files.select(corpus.relative(F.col("path"), root).alias("path"), markdown.frontmatter(F.col("content")).alias("frontmatter"), F.sha2(markdown.body(F.col("content")), 256).alias("body"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base records of all labels, overrides of the toxic ones; a bad toxic label's override is no JSON."""
    j = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    own = F.when(F.col("toxic") == 1, F.lit(None)).when(F.col("quality") == 0, text.body_hash(F.concat("text", F.lit("~")))).otherwise(text.body_hash(F.col("text")))
    fields = [number("doc_id").alias("slug"), F.col("source").alias("module"), F.concat(F.lit("Document "), number("doc_id")).alias("title"), own.alias("content_hash"), F.lit("A summary of it.").alias("ai_summary"), F.lit("Always.").alias("ai_when_to_use"), F.array(F.lit("topic")).alias("ai_related_topics"), F.lit("2026-03-09T00:00:00Z").alias("generated_at"), F.lit("m").alias("model"), F.lit(fixed.RECORD_VERSION).alias("pipeline_version")]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    path = F.concat("source", F.lit("/"), number("doc_id"), F.lit(".json"))
    base = j.select(F.concat(F.lit("base/"), path).alias("path"), record.alias("content"))
    over = j.where("toxic = 1").select(F.concat(F.lit("override/"), path).alias("path"), F.when(F.col("quality") == 1, record).otherwise("{broken").alias("content"))
    return base.unionByName(over)


def stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = tree(spark, sf_dir, "stores", lambda: _records(spark, sf_dir))
    return corpus.records(spark, f"{root}/base", "base"), corpus.records(spark, f"{root}/override", "override")


def scanned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What checks take of the documents, and the records of both layers, each read once: a check joins them several times."""
    docs = corpus.documents(spark, l2(spark, sf_dir))[0].select("module", "slug", "title", "body_hash")
    base, override = stores(spark, sf_dir)
    return lineage.cut(docs, "scanned-documents"), lineage.cut(base, "scanned-base"), lineage.cut(override, "scanned-override")


JOINED_SQL = "joined AS (SELECT d.source AS module, CAST(d.doc_id AS VARCHAR) AS slug, d.doc_id, d.text, quality, toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


@query(
    f"""WITH {JOINED_SQL}, r AS (SELECT 'base' AS store, module, slug, CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN left(sha256(text || '~'), 12) ELSE left(sha256(text), 12) END AS content_hash, true AS readable FROM joined
  UNION ALL SELECT 'override', module, slug, NULL, quality = 1 FROM joined WHERE toxic = 1)
SELECT store, module, slug, content_hash, readable, CASE WHEN readable THEN 'Document ' || slug END AS title, CAST(CASE WHEN readable THEN 10 ELSE 0 END AS INTEGER) AS n_fields FROM r"""
)
def scanned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, override = stores(spark, sf_dir)
    found = base.unionByName(override)
    return found.select("store", F.col("path_module").alias("module"), F.col("path_slug").alias("slug"), "content_hash", "readable", "title", F.when(F.col("readable"), F.size("present")).otherwise(0).alias("n_fields"))


SCANNED_SQL = f"""WITH {JOINED_SQL}, docs AS (SELECT source AS module, CAST(doc_id AS VARCHAR) AS slug FROM documents WHERE doc_id % 40 < 38),
audited AS (
  SELECT CASE WHEN toxic = 1 THEN CASE WHEN quality = 1 THEN 'override_pinned' ELSE 'invalid_override' END WHEN j.slug IS NULL THEN 'missing' WHEN quality = 0 THEN 'base_stale' ELSE 'base_current' END AS status
  FROM docs d LEFT JOIN joined j ON d.slug = j.slug
  UNION ALL SELECT 'orphan_base' FROM joined WHERE doc_id % 40 >= 38
  UNION ALL SELECT 'orphan_override' FROM joined WHERE doc_id % 40 >= 38 AND toxic = 1)
"""


@query(SCANNED_SQL + "SELECT status, count(*) AS n FROM audited GROUP BY status")
def scanned_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, base, override = scanned(spark, sf_dir)
    return store.audit_counts(store.audit(docs, corpus.layer(base), corpus.layer(override)))


@query(
    SCANNED_SQL
    + """, t AS (SELECT count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status LIKE '%stale') AS stale, count(*) FILTER (WHERE status LIKE 'orphan%') AS orphan, count(*) FILTER (WHERE status LIKE 'invalid%') AS invalid FROM audited)
SELECT array_to_string(list_filter(['missing=' || nullif(missing, 0), 'stale=' || nullif(stale, 0), 'orphan=' || nullif(orphan, 0), 'invalid=' || nullif(invalid, 0)], lambda x: x IS NOT NULL), ' ') AS labels FROM t"""
)
def failure_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.failure_labels(store.audit_totals(scanned_audit(spark, sf_dir))).select(F.array_join("labels", " ").alias("labels"))


@query(
    f"""WITH {JOINED_SQL}, r AS (SELECT 'base' AS store, *, true AS readable FROM joined UNION ALL SELECT 'override', *, quality = 1 FROM joined WHERE toxic = 1),
i AS (SELECT unnest([
  CASE WHEN NOT readable THEN 'error' END,
  CASE WHEN readable AND doc_id % 40 >= 38 THEN 'warning' END,
  CASE WHEN readable AND store = 'base' AND toxic = 0 AND quality = 0 AND doc_id % 40 < 38 THEN 'warning' END]) AS severity FROM r)
SELECT (SELECT count(*) FROM r) AS records, (SELECT count(*) FROM i WHERE severity = 'error') AS errors, (SELECT count(*) FROM i WHERE severity = 'warning') AS warnings"""
)
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records checked, errors and warnings of both layers; an unreadable record lacks all fields."""
    docs, base, override = scanned(spark, sf_dir)
    records = base.unionByName(override).withColumn("present", F.coalesce("present", F.array().cast("array<string>")))
    found, _ = store.preflight(records, docs, corpus.layer(base), corpus.layer(override))
    return spark.createDataFrame([store.validation_totals(records, found)], "records long, errors long, warnings long")


@query(
    f"""WITH {JOINED_SQL}, i AS (SELECT 'error: ' || module || '/' || slug || ': missing required fields {", ".join(fixed.REQUIRED_FIELDS)}' AS line, row_number() OVER (ORDER BY module, slug) AS rn, count(*) OVER () AS n FROM joined WHERE toxic = 1 AND quality = 0)
SELECT line FROM i WHERE rn <= 3 UNION ALL SELECT DISTINCT 'error: ... and ' || (n - 3) || ' more' FROM i WHERE n > 3"""
)
def bounded_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first errors of the override layer and how many more there are. (A report: the limit is the feature.)"""
    _, override = stores(spark, sf_dir)
    found = store.issues(override.withColumn("present", F.coalesce("present", F.array().cast("array<string>"))))
    return spark.createDataFrame([(x,) for x in sinks.check_report(found, errors=3).splitlines()], "line string")


@query("SELECT left(sha256(text), 12) AS hash, 'Summary ' || item_id AS summary, 'When ' || item_id AS when_to_use, CAST(1 + item_id % 3 AS INTEGER) AS n_topics FROM benchmark WHERE item_id % 4 <> 3")
def legacy_cache_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as an old cache in one JSON object; every fourth entry is no object."""

    def files() -> DataFrame:
        b = table(spark, sf_dir, "benchmark")
        entry = F.struct(F.concat(F.lit("Summary "), number("item_id")).alias("summary"), F.concat(F.lit("When "), number("item_id")).alias("when_to_use"), F.array_repeat(F.lit("t"), (F.col("item_id") % 3 + 1).cast("int")).alias("related_topics"))
        one = b.select(F.concat(F.to_json(F.array(text.body_hash(F.col("text")))).substr(F.lit(2), F.lit(14)), F.lit(": "), F.when(F.col("item_id") % 4 == 3, F.lit('"text"')).otherwise(F.to_json(entry))).alias("e"))
        return one.agg(F.concat(F.lit("{"), F.array_join(F.collect_list("e"), ", "), F.lit("}")).alias("content")).select(F.lit("cache.json").alias("path"), "content")

    root = tree(spark, sf_dir, "cache", files)
    return corpus.legacy_cache(spark, f"{root}/cache.json").select("hash", "summary", "when_to_use", F.size("related_topics").alias("n_topics"))


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'env' || n_nationkey WHEN n_nationkey % 5 = 0 THEN 'unknown' ELSE left(sha256(n_name), 10) END AS \"commit\" FROM nation")
def manifest_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as repositories: a third has a value in the environment, a fifth of the rest is in no manifest; the first candidate file is not there."""
    nations = [(r["n_nationkey"], r["n_name"]) for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()]  # a reference table of 25 rows

    def files() -> DataFrame:
        n = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0")
        entry = F.map_from_entries(F.collect_list(F.struct("n_name", text.body_hash(F.col("n_name"), 10))))
        return n.agg(F.to_json(entry).alias("content")).select(F.lit("manifest.json").alias("path"), "content")

    root = tree(spark, sf_dir, "manifest", files)
    found, _ = corpus.manifest(spark, [f"{root}/none.json", f"{root}/none.json", f"{root}/manifest.json"])
    known = corpus.commits({name: f"env{k}" if k % 3 == 0 else None for k, name in nations}, found)
    return spark.createDataFrame(list(known.items()), "name string, commit string")


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS ordinal, 'wiki' AS source, n_name AS identifier, CASE WHEN n_nationkey % 2 = 0 THEN 'exact' END AS match_type, CASE WHEN n_nationkey % 3 = 0 THEN 'old: page ' || n_nationkey END AS reason FROM nation")
def policy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the entries of an exclusion policy in YAML."""

    def files() -> DataFrame:
        n = table(spark, sf_dir, "nation")
        entry = F.concat(F.lit("- source: wiki\n  identifier: "), F.to_json(F.array("n_name")).substr(F.lit(2), F.length("n_name") + 2), F.when(F.col("n_nationkey") % 2 == 0, F.lit("\n  match_type: exact")).otherwise(""), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('\n  reason: "old: page '), number("n_nationkey"), F.lit('"'))).otherwise(""))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", entry.alias("e")))), lambda x: x["e"])
        return n.agg(F.array_join(ordered, "\n").alias("content")).select(F.lit("policy.yml").alias("path"), "content")

    return corpus.policy(spark, tree(spark, sf_dir, "policy", files) + "/policy.yml")


# --- mail --------------------------------------------------------------------------------------------------------------

FROM_LINE = "From user at example.com  Mon Mar  9 10:00:00 2026"
#: What a turn looks like as a message: the text of its headers, for Spark and for the statement.
MESSAGE_SQL = f"""'{FROM_LINE}' || chr(10) || 'Message-ID: <' || conv_id || '-' || turn || '@x>' || chr(10)
  || CASE WHEN turn > 0 THEN 'In-Reply-To: <' || conv_id || '-' || (turn - 1) || '@x>' || chr(10) ELSE '' END
  || 'From: ' || role || ' at example.com (' || upper(role) || ')' || chr(10) || 'Date: Mon, 09 Mar 2026 10:0' || (turn % 10) || ':00 +0100 (CET)' || chr(10)
  || 'Subject: =?utf-8?q?Turn_=C3=A9_' || turn || '?=' || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(10) || 'Content-Transfer-Encoding: 8bit' || chr(10) || chr(10) || text || chr(10)"""


def _message() -> Column:
    n = F.lit("\n")
    ident = lambda turn: F.concat(F.lit("<"), number("conv_id"), F.lit("-"), turn.cast("string"), F.lit("@x>"))
    reply = F.when(F.col("turn") > 0, F.concat(F.lit("In-Reply-To: "), ident(F.col("turn") - 1), n)).otherwise("")
    sender = F.concat(F.lit("From: "), "role", F.lit(" at example.com ("), F.upper("role"), F.lit(")"), n)
    date = F.concat(F.lit("Date: Mon, 09 Mar 2026 10:0"), (F.col("turn") % 10).cast("string"), F.lit(":00 +0100 (CET)"), n)
    subject = F.concat(F.lit("Subject: =?utf-8?q?Turn_=C3=A9_"), number("turn"), F.lit("?="), n)
    return F.concat(F.lit(FROM_LINE), n, F.lit("Message-ID: "), ident(F.col("turn")), n, reply, sender, date, subject, F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"), "text", n)


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("role", F.floor(F.col("conv_id") / 50).cast("string").alias("month"), F.struct("conv_id", "turn", _message().alias("m")).alias("x"))
    whole = c.groupBy("role", "month").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["m"]), "").alias("content"))
    return whole.select(F.concat(F.lit("devel/"), "role", F.lit("-"), "month", F.lit(".txt")).alias("path"), "content")


def archives(spark: SparkSession, sf_dir: str) -> str:
    return tree(spark, sf_dir, "mail", lambda: _archives(spark, sf_dir))


PARSED_SQL = f"""turns AS (SELECT *, {MESSAGE_SQL} AS m FROM conversations),
placed AS (SELECT *, CAST(coalesce(sum(octet_length(encode(m))) OVER (PARTITION BY role, conv_id // 50 ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset, trim(text, ' ' || chr(10) || chr(9)) AS body FROM turns)"""


@query(
    f"""WITH {PARSED_SQL} SELECT 'devel/' || role || '-' || (conv_id // 50) || '.txt' AS source_file, 'https://lists.example.org/devel/' || role || '-' || (conv_id // 50) || '.txt' AS archive_url, byte_offset, '{FROM_LINE}' AS mbox_from_line, '<' || conv_id || '-' || turn || '@x>' AS message_id,
  CASE WHEN turn > 0 THEN '<' || conv_id || '-' || (turn - 1) || '@x>' END AS in_reply_to, role || '@example.com' AS from_addr, '' AS from_name, '2026-03-09T10:0' || (turn % 10) || ':00+01:00' AS date_iso, 'Turn é ' || turn AS subject, sha256(body) AS body, array_to_string({KEYWORDS_SQL.replace("(text,", "(subj || chr(10) || body,")}, ' ') AS keywords
FROM (SELECT *, 'Turn é ' || turn AS subj FROM placed)"""
)
def mail_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in an archive for each role and fifty conversations, read by ranges of 32 KB and parsed."""
    found = corpus.parsed_archives(spark, archives(spark, sf_dir), {"devel/": "https://lists.example.org/devel/"}, range_bytes=1 << 15)
    return found.select("source_file", "archive_url", "byte_offset", "mbox_from_line", "message_id", "in_reply_to", "from_addr", "from_name", "date_iso", "subject", F.sha2("body_for_scoring", 256).alias("body"), F.array_join("keyword_matches", " ").alias("keywords"))


@query(
    f"""WITH {PARSED_SQL}, k AS (SELECT *, len({KEYWORDS_SQL.replace("(text,", "(subj || chr(10) || body,")}) AS n_keywords FROM (SELECT *, 'Turn é ' || turn AS subj FROM placed)),
d AS (SELECT CASE WHEN turn = 0 AND (length(regexp_replace(subj || ' ' || body, '[^A-Za-z]', '', 'g')) < 20 OR (n_keywords = 0 AND length(body) < 40)) THEN 'dropped' ELSE 'primary' END AS disposition, n_keywords > 0 AS hit FROM k)
SELECT count(*) AS messages_parsed, count(*) FILTER (WHERE disposition = 'primary') AS primary, count(*) FILTER (WHERE disposition = 'sidelined') AS sidelined, count(*) FILTER (WHERE disposition = 'dropped') AS dropped, count(*) FILTER (WHERE hit) AS with_keywords,
  round(count(*) FILTER (WHERE hit) * 100.0 / count(*), 1) AS keyword_match_rate FROM d"""
)
def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail.parse_stats(corpus.parsed_archives(spark, archives(spark, sf_dir)))


@query(
    f"""WITH {PARSED_SQL}, q AS (SELECT conv_id, turn, '> ' || replace(text, chr(10), chr(10) || '> ') || chr(10) || 'This is wrong, use the other one.' || chr(10) || 'diff --git a/package/x' || turn || '.c b/package/x.c' || chr(10) || '@@ -1,2 +1,2 @@ int main()' || chr(10) || '-a' || chr(10) || '+b' || chr(10) || ' c' AS b FROM turns)
SELECT conv_id, turn, q.b IS NOT NULL AS quoted, 'package/x' || turn || '.c' AS files, sha256(trim('> ' || replace(text, chr(10), chr(10) || '> '), ' ' || chr(10)) || chr(10) || 'This is wrong, use the other one.' || chr(10) || '[diff: package/x' || turn || '.c]' || chr(10) || '[hunk: int main()]' || chr(10) || '-a' || chr(10) || '+b') AS plain,
  'This is wrong, use the other one.' || chr(10) || '[diff: package/x' || turn || '.c]' || chr(10) || '[hunk: int main()]' || chr(10) || '-a' || chr(10) || '+b' AS scoring, sha256(trim(text, ' ' || chr(10))) AS quote, CAST(len(string_split(text, chr(10))) AS BIGINT) AS line_index
FROM turns JOIN q USING (conv_id, turn)"""
)
def text_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn quoted in an answer that corrects it and brings a diff."""
    c = table(spark, sf_dir, "conversations")
    body = F.concat(F.lit("> "), F.replace("text", F.lit("\n"), F.lit("\n> ")), F.lit("\nThis is wrong, use the other one.\ndiff --git a/package/x"), number("turn"), F.lit(".c b/package/x.c\n@@ -1,2 +1,2 @@ int main()\n-a\n+b\n c"))
    raw = F.concat(F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"), body).cast("binary")
    v = c.select("conv_id", "turn", mail.parsed(raw).alias("v"))
    pair = F.col("v.quoted_context_pairs")[0]
    return v.select("conv_id", "turn", (F.size("v.quoted_context_pairs") == 1).alias("quoted"), F.array_join("v.mentioned_files", " ").alias("files"), F.sha2("v.body_no_diff", 256).alias("plain"), F.col("v.body_for_scoring").alias("scoring"), F.sha2(pair["quoted"], 256).alias("quote"), pair["line_index"].alias("line_index"))


# --- sources and sinks -------------------------------------------------------------------------------------------------


@query("SELECT printf('%02d', item_id) AS id, trim(text) AS body, CASE WHEN item_id % 2 = 0 THEN 'net' END AS domain FROM benchmark WHERE item_id < 100")
def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as scenarios of a document, numbered by two digits; the even ones have metadata."""
    b = table(spark, sf_dir, "benchmark").where("item_id < 100")
    ident = F.lpad(number("item_id"), 2, "0")
    block = F.concat(F.lit("## Scenario "), ident, F.lit("\n"), "text", F.lit("\n"))
    doc = b.agg(F.concat(F.lit("# All\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", block.alias("b")))), lambda x: x["b"]), "\n")).alias("content"))
    return corpus.scenarios(doc, b.where("item_id % 2 = 0").select(ident.alias("id"), F.lit("net").alias("domain")))


@query("SELECT CASE quality WHEN 1 THEN 'PASS' ELSE 'FAIL' END AS verdict, count(*) AS n FROM labels GROUP BY 1")
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as JSON objects written one behind the other, three or so a line; braces in a string are no break."""
    one = F.to_json(F.struct(F.when(F.col("quality") == 1, "PASS").otherwise("FAIL").alias("verdict"), F.lit("}{").alias("note")))
    lines = table(spark, sf_dir, "labels").groupBy((F.col("doc_id") % 97).alias("g")).agg(F.array_join(F.collect_list(one), "").alias("value"))
    return corpus.concatenated_json(lines, "verdict string, note string").groupBy("verdict").agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT sum(octet_length(encode(html))) AS a, sum(octet_length(encode(regexp_replace(html, '<[^>]*>', '', 'g')))) AS b FROM pages) SELECT CAST(a AS BIGINT) AS bytes_in, CAST(b AS BIGINT) AS bytes_out, round((a - b) * 100.0 / a, 1) AS percent FROM r")
def parse_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the pages without their tags."""
    p = table(spark, sf_dir, "pages").select(F.col("html").alias("before"), F.regexp_replace("html", "<[^>]*>", "").alias("after"))
    return threads.reduction(p, "before", "after")


@query("SELECT 'bench/readme-' || item_id || '.md' AS path, sha256(text) AS content FROM benchmark UNION ALL SELECT 'bench/readme-' || item_id || '.meta.json', left(sha256(text), 8) || ' bench readme ' || item_id || ' v' FROM benchmark")
def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items written as pages with sidecars; of a sidecar its fields."""
    b = table(spark, sf_dir, "benchmark").select(F.lit("bench").alias("module"), F.lit("readme").alias("origin_type"), number("item_id").alias("slug"), F.col("text").alias("content"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"))
    root = tree(spark, sf_dir, "pairs", lambda: sinks.raw_pairs(b))
    side = F.from_json("content", "content_hash string, module string, origin_type string, slug string, k string")
    shown = F.when(F.col("path").endswith(".md"), F.sha2("content", 256)).otherwise(F.concat_ws(" ", *[side[c] for c in ("content_hash", "module", "origin_type", "slug", "k")]))
    return corpus.whole_files(spark, root, "*").select(corpus.relative(F.col("path"), root).alias("path"), shown.alias("content"))


@query("SELECT item_id, '# Item ' || item_id || chr(10) || chr(10) || '```text' || chr(10) || text || chr(10) || '```' || chr(10) AS page FROM benchmark")
def code_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", sinks.code_block(F.concat(F.lit("Item "), number("item_id")), F.col("text"), F.lit("text")).alias("page"))


@query("SELECT item_id, 'text' AS lang, sha256(text) AS code FROM benchmark")
def fenced_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of those pages, found again."""
    b = code_pages(spark, sf_dir).select("item_id", F.explode(markdown.blocks("page")).alias("b"))
    return b.select("item_id", "b.lang", F.sha2("b.code", 256).alias("code"))


@query("SELECT '{\"doc_id\":' || doc_id || ',\"quality\":' || quality || ',\"toxic\":' || CASE WHEN toxic = 1 THEN '1' ELSE 'null' END || '}' AS value FROM labels")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as JSON lines; null fields are written."""
    path = f"{lineage.shared_dir(spark)}/json-lines-{uuid.uuid4().hex}"
    lineage._written.append((spark, path))
    sinks.json_lines(table(spark, sf_dir, "labels").select("doc_id", "quality", F.when(F.col("toxic") == 1, 1).alias("toxic")), path)
    return spark.read.text(path)


@query("SELECT 'bench/' || item_id || '.md' AS path, sha256(text) AS content FROM benchmark WHERE item_id % 4 < 3")
def synced_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree made equal to another: files that are new or differ are copied, others are deleted."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit("bench/"), number("item_id"), F.lit(".md")).alias("path"), F.col("text").alias("content"))
    source = tree(spark, sf_dir, "sync-source", lambda: b.where("item_id % 4 < 3"))
    target = f"{lineage.shared_dir(spark)}/sync-target-{uuid.uuid4().hex}"
    lineage._written.append((spark, target))
    runs.write_tree(b.where("item_id % 4 > 1").withColumn("content", F.when(F.col("item_id") % 4 == 2, F.lit("other")).otherwise(F.col("content"))), target)
    runs.apply_plan(layout.sync_plan(runs.listing(spark, source), runs.listing(spark, target), delete_extra=True), source, target)
    return corpus.whole_files(spark, target, "*.md").select(corpus.relative(F.col("path"), target).alias("path"), F.sha2("content", 256).alias("content"))


@query("SELECT 'docs/' || source || '/' || doc_id || '.md' AS name, sha256(CASE WHEN doc_id % 40 = 39 THEN text WHEN doc_id % 40 = 38 THEN '---' || chr(10) || '- a' || chr(10) || '- b' || chr(10) || '---' || chr(10) || text ELSE '---' || chr(10) || 'title: Document ' || doc_id || chr(10) || 'module: ' || source || chr(10) || 'token_count: ' || n_chars || chr(10) || '---' || chr(10) || text END) AS content FROM documents")
def packaged_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of pages as a package that tasks have put together, unpacked again."""
    folder = f"{lineage.shared_dir(spark)}/packages-{uuid.uuid4().hex}"
    lineage._written.append((spark, folder))
    path = packages.package(spark, l2(spark, sf_dir), folder, "docs", "run", hosted=True)
    return packages.unpacked(spark, path).select("name", F.sha2("content", 256).alias("content"))


@query("SELECT CAST(doc_id AS VARCHAR) AS path, CASE doc_id % 5 WHEN 0 THEN 'copy' WHEN 1 THEN 'copy' WHEN 2 THEN 'skip' WHEN 3 THEN 'keep' ELSE 'skip' END AS action FROM documents WHERE doc_id % 7 <> 0")
def sync_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal sizes: a file that is a second younger is copied, one that differs by a thousandth is not; new ones are, links and what only the target has are left."""
    d = table(spark, sf_dir, "documents").select(number("doc_id").alias("path"), (F.col("doc_id") % 5).alias("k"), F.col("n_chars").alias("size"), (F.col("doc_id") % 7 == 0).alias("is_link"))
    s = d.where("k <> 3").withColumn("mtime", F.lit(100.0))
    t = d.where("k <> 0").withColumn("mtime", F.when(F.col("k") == 1, 99.0).when(F.col("k") == 2, 100.001).otherwise(100.0))
    return layout.sync_plan(s, t, delete_extra=False)


# --- records, once more ------------------------------------------------------------------------------------------------


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels")  # noqa: E741
    return l.select(F.lit("m").alias("module"), number("doc_id").alias("slug"), F.concat(F.lit("Title "), number("doc_id")).alias("title"), F.when(F.col("toxic") == 0, F.concat(F.lit("h"), number("doc_id"))).alias("content_hash"), F.when(F.col("quality") == 1, "2026-01-01").alias("generated_at"), F.lit(None).cast("string").alias("saved_at"), F.lit("gen").alias("model"), F.when(F.col("doc_id") % 2 == 0, "v11").alias("pipeline_version"), (F.col("doc_id") % 9 != 0).alias("readable"), "doc_id", "quality", "toxic")


@query(f"SELECT CAST(doc_id AS VARCHAR) AS slug, CASE WHEN quality = 0 THEN 'now' ELSE '2026-01-01' END AS generated_at, CASE WHEN doc_id % 3 = 0 THEN 'now' END AS saved_at, CASE WHEN doc_id % 2 = 0 THEN 'v11' WHEN doc_id % 3 = 0 THEN '{fixed.RECORD_VERSION}' END AS pipeline_version FROM labels WHERE NOT (quality = 0 AND doc_id % 3 <> 0) UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, CASE WHEN doc_id % 2 = 0 THEN 'v11' END FROM labels WHERE quality = 0 AND doc_id % 3 <> 0")
def saved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third record is saved again."""
    old = _layer(spark, sf_dir)
    return store.save(old, old.where("doc_id % 3 = 0"), "now").select("slug", "generated_at", "saved_at", "pipeline_version")


@query("SELECT CAST(doc_id AS VARCHAR) AS slug, CAST(NULL AS VARCHAR) AS content_hash, 'manual-override' AS model FROM labels WHERE doc_id % 9 <> 0 AND toxic = 0 AND doc_id % 2 = 0")
def forked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides for the even ones: not where the base can't be read, nor where an override is there (the toxic ones)."""
    base = _layer(spark, sf_dir)
    return store.fork(base, base.where("toxic = 1"), base.where("doc_id % 2 = 0").select("module", "slug")).select("slug", "content_hash", "model")


@query("SELECT CAST(doc_id AS VARCHAR) AS slug, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS origin, (SELECT count(*) FROM labels WHERE doc_id % 3 = 0) AS promoted FROM labels WHERE doc_id % 3 = 0 OR quality = 1")
def promoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _layer(spark, sf_dir)
    out, n = store.promote(base.where("quality = 1").withColumn("origin", F.lit("old")), base.where("doc_id % 3 = 0").withColumn("origin", F.lit("new")))
    return out.select("slug", "origin", F.lit(n).cast("long").alias("promoted"))


@query("SELECT CAST(doc_id AS VARCHAR) AS slug, 'Title ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '!' ELSE '' END AS title, CASE WHEN quality = 1 THEN '2026-01-01' ELSE 'now' END AS generated_at FROM labels WHERE doc_id % 9 <> 0 AND toxic = 0 AND (quality = 0 OR doc_id % 2 = 0)")
def repaired_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents have another title than their record; bad ones' records have no date; toxic ones an override."""
    base = _layer(spark, sf_dir)
    docs = base.select("module", "slug", F.concat("title", F.when(F.col("doc_id") % 2 == 0, "!").otherwise("")).alias("title"), F.concat(F.lit("h"), number("doc_id")).alias("body_hash"))
    return store.repaired(docs, base, base.where("toxic = 1").select("module", "slug"), "now").select("slug", "title", "generated_at")


@query("WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM labels WHERE quality = 0) SELECT doc_id, CASE WHEN quality = 1 THEN 'stored' WHEN rn <= 20 THEN 'generate' ELSE 'waiting' END AS decision FROM labels LEFT JOIN g USING (doc_id)")
def capped_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty calls are paid for. (The limit is the feature.)"""
    decided = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "stored").otherwise("generate").alias("decision"))
    return store.capped(decided, 20, "doc_id")


@query(
    """WITH c AS (SELECT doc_id, quality, toxic, count(*) FILTER (WHERE quality = 1) OVER w AS hits, count(*) FILTER (WHERE quality = 0 AND toxic = 1 AND doc_id % 50 = 7) OVER w AS stops FROM labels WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, CASE WHEN hits < 30 AND stops = 0 THEN 'made' ELSE 'waiting' END AS state FROM c"""
)
def successful_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as calls: the good ones succeed, and thirty successes are paid for; a toxic one now and then says stop. (The limit is the feature.)"""
    stop = (F.col("toxic") == 1) & (F.col("doc_id") % 50 == 7)
    calls = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "success").when(stop, "stop").otherwise("failure").alias("outcome"))
    return store.capped_by_success(calls, 30, "doc_id").select("doc_id", "state")


@query("SELECT doc_id, '---' || chr(10) || 'title: T' || chr(10) || CASE WHEN quality = 1 THEN 'ai_summary: \"Good \\\\ ' || doc_id || '\"' ELSE 'ai_summary: old' END || chr(10) || 'module: m' || CASE WHEN quality = 1 THEN chr(10) || 'ai_when_to_use: \"Always.\"' || chr(10) || 'ai_related_topics: [\"a\",\"b\"]' ELSE '' END || chr(10) || '---' || chr(10) || 'Body' AS content FROM labels")
def injected_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good labels have a summary: it takes the old one's place, the other fields come last."""
    good = F.col("quality") == 1
    docs = table(spark, sf_dir, "labels").select("doc_id", F.lit("title: T\nai_summary: old\nmodule: m").alias("frontmatter"), F.lit("Body").alias("body"), F.when(good, F.concat(F.lit("Good \\ "), number("doc_id"))).alias("ai_summary"), F.when(good, "Always.").alias("ai_when_to_use"), F.when(good, F.array(F.lit("a"), F.lit("b"))).alias("ai_related_topics"))
    return release.inject_summary(docs).select("doc_id", "content")


# --- trees, links, checks ----------------------------------------------------------------------------------------------


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    target = F.concat(F.lit("../src0/"), (F.col("doc_id") * 20).cast("string"), F.lit(".md"))
    content = F.concat(F.lit("See [x]("), target, F.lit(") and [y]("), (F.col("doc_id") + 20).cast("string"), F.lit(".md#part), not [z](https://example.org/a.md) or [w](#top) or [v](img.png) or [u](../../src0/1.md)."))
    return d.select(F.concat("source", F.lit("/"), number("doc_id"), F.lit(".md")).alias("path"), content.alias("content"), "doc_id")


@query(
    """WITH l AS (SELECT source || '/' || doc_id || '.md' AS path, unnest(['../src0/' || (doc_id * 20) || '.md', (doc_id + 20) || '.md#part', '../../src0/1.md']) AS target, unnest(['src0/' || (doc_id * 20) || '.md', source || '/' || (doc_id + 20) || '.md', '../src0/1.md']) AS resolved FROM documents)
SELECT path, target, resolved FROM l WHERE resolved NOT IN (SELECT source || '/' || doc_id || '.md' FROM documents)"""
)
def dead_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document links to one of the source src0, to its neighbour, to a file above the tree, and to what is not looked at."""
    pages = _linked(spark, sf_dir)
    return layout.dead_links(pages, pages)


@query(
    """SELECT doc_id, replace(b, '](../src0/' || (doc_id * 20) || '.md)', '](../L2-semantic/src0/' || (doc_id * 20) || '.md)') AS stable, replace(b, '](../src0/' || (doc_id * 20) || '.md)', '](../src0/chunked-reference/' || (doc_id * 20) || '.md)') AS release,
  replace(b, '](../src0/' || (doc_id * 20) || '.md)', '](../../src0/chunked-reference/' || (doc_id * 20) || '.md)') AS chunked
FROM (SELECT doc_id, 'See [x](../src0/' || (doc_id * 20) || '.md) and [y](' || (doc_id + 20) || '.md#part), not [z](https://example.org/a.md) or [w](#top) or [v](img.png) or [u](../../src0/1.md).' AS b FROM documents)"""
)
def rewritten_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).select("doc_id", *[layout.rewrite_links(F.col("content"), t).alias(t) for t in ("stable", "release", "chunked")])


def _release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release tree of all sources: those whose name ends in 1 lack their map, those in 2 their pages; the page of a document with ``doc_id % 50 = 3`` names a stale field."""
    d = table(spark, sf_dir, "documents")
    m = d.select("source").distinct()
    odd = F.col("source").endswith
    files = [m.select(F.concat("source", F.lit(f"/{n}")).alias("path"), F.lit("x").alias("content"), (odd("1") & F.lit(n == "map.md")).alias("gone")) for n in layout.MODULE_FILES]
    pages = d.select(F.concat("source", F.lit("/chunked-reference/"), number("doc_id"), F.lit(".md")).alias("path"), F.when(F.col("doc_id") % 50 == 3, F.lit("---\ntitle: t\nupstream_path: x\n---\nb")).otherwise("b").alias("content"), odd("2").alias("gone"))
    listed = m.where(~odd("3")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("source")), lambda s: F.concat(F.lit('<a href="./'), s, F.lit('/llms.txt">'))), "\n").alias("content"))
    root = spark.createDataFrame([(n, "# T\n- [a](a/llms.txt)" + "x" * 600) for n in layout.ROOT_FILES if n not in ("AGENTS.md", "index.html")], "path string, content string")
    out = root.unionByName(listed.select(F.lit("index.html").alias("path"), "content"))
    for f in [*files, pages]:
        out = out.unionByName(f.where("not gone").select("path", "content"))
    return out


@query(
    """WITH m AS (SELECT DISTINCT source AS s FROM documents)
SELECT 'root file missing' AS "check", 'AGENTS.md' AS subject UNION ALL SELECT 'module file missing', s || '/map.md' FROM m WHERE s LIKE '%1' UNION ALL SELECT 'no chunked pages', s FROM m WHERE s LIKE '%2'
UNION ALL SELECT 'module not expected', s FROM m WHERE s LIKE '%4' UNION ALL SELECT 'module missing', s || 'x' FROM m WHERE s LIKE '%5' UNION ALL SELECT 'index lacks a module', s || '/llms.txt' FROM m WHERE s LIKE '%3'
UNION ALL SELECT 'stale field', source || '/chunked-reference/' || doc_id || '.md' FROM documents WHERE doc_id % 50 = 3 AND source NOT LIKE '%2'"""
)
def tree_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that release tree lacks; of the expected modules those in 4 are left out and those in 5 are expected twice, once under a name that is not there."""
    s = table(spark, sf_dir, "documents").select(F.col("source").alias("module")).distinct()
    expected = s.where(~F.col("module").endswith("4")).unionByName(s.where(F.col("module").endswith("5")).select(F.concat("module", F.lit("x")).alias("module")))
    files = _release(spark, sf_dir)
    return layout.tree_problems(files, expected).unionByName(layout.page_problems(files))


@query("SELECT doc_id || '.md' AS path FROM documents WHERE n_chars > 3000")
def catalogue_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue that lists the documents of up to 3000 characters."""
    d = table(spark, sf_dir, "documents").select(F.concat(number("doc_id"), F.lit(".md")).alias("path"), "n_chars")
    return layout.incomplete_catalogue(d.select("path"), d.where("n_chars <= 3000").select("path"))


@query("SELECT CAST(doc_id AS VARCHAR) AS path, 'found ' || lang AS message FROM documents WHERE NOT (doc_id % 2 = 0 AND lang = 'en')")
def new_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all documents; those in even ones are known with the message for English."""
    d = table(spark, sf_dir, "documents").select(number("doc_id").alias("path"), F.concat(F.lit("found "), "lang").alias("message"), "doc_id")
    known = d.where("doc_id % 2 = 0").select("path", F.lit("found en").alias("message"))
    return layout.known_false_positives(d.select("path", "message"), known).select("path", "message")


@query("SELECT CAST(d.doc_id AS VARCHAR) AS path FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR quality = 0")
def mirror_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror of the labelled documents, the bad ones with a character more."""
    d = table(spark, sf_dir, "documents").select(number("doc_id").alias("path"), F.col("text").alias("content"), "doc_id")
    mirror = d.join(table(spark, sf_dir, "labels"), "doc_id").select("path", F.when(F.col("quality") == 0, F.concat("content", F.lit("~"))).otherwise(F.col("content")).alias("content"))
    return layout.content_mismatches(d.select("path", "content"), mirror)


@query(
    """WITH a AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 304 WHEN 1 THEN 503 ELSE 200 END AS status, CASE WHEN page_id % 6 = 2 THEN sha256(url) ELSE 'new' END AS raw_hash, CASE WHEN page_id % 10 = 9 THEN '2019-01-01' ELSE '2026-01-01' END AS lm, page_id % 6 = 3 AS is_error FROM pages WHERE page_id % 8 <> 7),
c AS (SELECT page_id, sha256(url) AS h, page_id % 15 = 4 AS corrupted FROM pages WHERE page_id % 3 <> 1)
SELECT coalesce(a.page_id, c.page_id) AS page_id, CASE WHEN a.page_id IS NULL THEN 'orphan' WHEN lm < '2020-01-01' THEN 'expired' WHEN status >= 400 OR is_error THEN CASE WHEN c.page_id IS NOT NULL THEN 'reuse' ELSE 'fail' END WHEN corrupted THEN 'refetch' WHEN status = 304 OR raw_hash = h THEN 'skip' ELSE 'convert' END AS action
FROM a FULL OUTER JOIN c ON a.page_id = c.page_id"""
)
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as arrivals and as a cache: some older than the cutoff, failed, errors, not modified, corrupted, or not found any more."""
    p = table(spark, sf_dir, "pages")
    k, h = F.col("page_id") % 6, F.sha2("url", 256)
    a = p.where("page_id % 8 <> 7").select(F.col("page_id").alias("url"), F.when(k == 0, 304).when(k == 1, 503).otherwise(200).alias("status"), F.when(k == 2, h).otherwise("new").alias("raw_hash"), F.when(F.col("page_id") % 10 == 9, "2019-01-01").otherwise("2026-01-01").alias("last_modified"), (k == 3).alias("is_error"))
    c = p.where("page_id % 3 <> 1").select(F.col("page_id").alias("url"), h.alias("raw_hash"), (F.col("page_id") % 15 == 4).alias("corrupted"))
    return layout.cache_plan(a, c, "2020-01-01").select(F.col("url").alias("page_id"), "action")


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls over the pages: texts that change, are short or are not modified, failed fetches, old pages, outputs that were lost."""
    p = table(spark, sf_dir, "pages").where("url is not null").groupBy("url").agg(F.min("page_id").alias("k"), F.min("html").alias("html"))
    each = p.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("seq"))
    k, seq = F.col("k"), F.col("seq")
    raw = F.when(k % 9 == 4, "tiny").when((k % 7 == 2) & (seq == 2), F.concat("html", F.lit("new"))).otherwise(F.col("html"))
    status = F.when((k + seq) % 6 == 5, 503).when((k % 5 == 1) & (seq > 0), 304).otherwise(200)
    was = F.when(k % 9 == 4, "tiny").otherwise(F.col("html"))
    stored = F.when((seq > 0) & ((k + seq) % 11 != 3), crawl.content_hash_of(was))
    return each.select("url", "seq", status.alias("status"), F.when(status == 200, raw).alias("raw"), F.when((k % 13 == 5) & (seq == 1), "2019-01-01").alias("last_modified"), (k % 17 == 6).alias("is_error"), stored.alias("stored_hash"))


def _crawl_sql() -> str:
    """Three crawls one after the other, each a join with what the one before left."""
    fetches = """p AS (SELECT url, min(page_id) AS k, min(html) AS html FROM pages WHERE url IS NOT NULL GROUP BY url), e AS (SELECT *, unnest([0, 1, 2])::BIGINT AS seq FROM p),
s AS (SELECT url, seq, k, CASE WHEN (k + seq) % 6 = 5 THEN 503 WHEN k % 5 = 1 AND seq > 0 THEN 304 ELSE 200 END AS status, CASE WHEN k % 9 = 4 THEN 'tiny' WHEN k % 7 = 2 AND seq = 2 THEN html || 'new' ELSE html END AS text, CASE WHEN k % 9 = 4 THEN 'tiny' ELSE html END AS was FROM e),
f AS (SELECT url, seq, status, CASE WHEN status = 200 THEN text END AS raw, CASE WHEN k % 13 = 5 AND seq = 1 THEN '2019-01-01' END AS modified, k % 17 = 6 AS is_error, CASE WHEN seq > 0 AND (k + seq) % 11 <> 3 THEN sha256('output of ' || sha256(was)) END AS stored FROM s),
n0 AS (SELECT CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS rh, CAST(NULL AS VARCHAR) AS ch, CAST(NULL AS VARCHAR) AS sr WHERE false)"""
    steps = []
    for i in range(3):
        steps.append(f"""j{i} AS (SELECT f.*, sha256(raw) AS h, n.url IS NOT NULL AS was, n.rh, n.ch, n.sr, coalesce(n.ch = f.stored, false) AS whole, (status >= 400 OR is_error OR (status <> 304 AND raw IS NULL)) AS bad, (status = 304 OR coalesce(sha256(raw) = n.rh, false)) AS seen FROM f LEFT JOIN n{i} n ON n.url = f.url WHERE seq = {i}),
o{i} AS (SELECT *, CASE WHEN modified < '2020-01-01' THEN 'expired' WHEN bad THEN CASE WHEN whole THEN 'reuse' ELSE 'fail' END WHEN seen AND was AND coalesce(sr = 'short', false) THEN 'short' WHEN seen AND whole THEN 'skip' WHEN raw IS NULL THEN 'fail' WHEN length(raw) < 100 THEN 'short' WHEN was AND ch IS NOT NULL AND NOT whole THEN 'refetch' ELSE 'convert' END AS action FROM j{i}),
n{i + 1} AS (SELECT url, CASE WHEN action IN ('convert', 'refetch') OR (action = 'short' AND NOT (seen AND sr = 'short' AND was)) THEN h ELSE rh END AS rh, CASE WHEN action IN ('convert', 'refetch') THEN sha256('output of ' || h) WHEN action = 'short' THEN NULL ELSE ch END AS ch, CASE WHEN action = 'short' THEN 'short' WHEN action IN ('convert', 'refetch') THEN NULL ELSE sr END AS sr FROM o{i} WHERE action <> 'expired' AND (action NOT IN ('reuse', 'fail') OR (bad AND was)))""")
    return "WITH " + ",\n".join([fetches, *steps])


@query(_crawl_sql() + " SELECT url, seq, action FROM o0 UNION ALL SELECT url, seq, action FROM o1 UNION ALL SELECT url, seq, action FROM o2")
def crawl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls taken in as a stream, each as it has landed, in two runs over one checkpoint."""
    root = f"{lineage.shared_dir(spark)}/crawl-{uuid.uuid4().hex}"
    lineage._written.append((spark, root))
    found = lineage.cut(_fetches(spark, sf_dir), "crawl-fetches")
    for seqs in ([0, 1], [2]):
        for i in seqs:
            found.where(F.col("seq") == i).write.parquet(f"{root}/landed/{i}")
        crawl.run(spark, f"{root}/landed", f"{root}/out", f"{root}/checkpoint", "2020-01-01")
    return spark.read.schema(crawl.OUTCOME).parquet(f"{root}/out").select("url", "seq", "action")


@query(_crawl_sql() + " SELECT url, action FROM o2")
def crawl_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three crawls as batch plans, each against the records that the one before left; the outcomes of the last."""
    found, seen = _fetches(spark, sf_dir), None
    kept = spark.createDataFrame([], "url string, raw_hash string, content_hash string, last_modified string, skip_reason string")
    for i in range(3):
        seen = lineage.cut(crawl.plan(found.where(F.col("seq") == i), kept, "2020-01-01"), "crawl-plan")
        kept = crawl.records(seen)
    return seen.select("url", "action")


@query("SELECT page_id, CASE WHEN NOT regexp_matches(host, '(^|\\.)example\\.com$') THEN 'off-site' WHEN page_id % 7 = 0 THEN 'redirected' WHEN page_id % 7 = 1 THEN 'challenge' ELSE 'kept' END AS verdict FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)")
def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the site example.com; every seventh page was led to another host, the next one is a bot guard's page."""
    k = F.col("page_id") % 7
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.when(k == 0, "https://login.example.net/").when(k == 2, "https://www.example.com/x").alias("final"), F.when(k == 1, F.concat(F.lit("Just a moment..."), "html")).otherwise(F.col("html")).alias("html"))
    return p.select("page_id", corpus.fetched_verdict(F.col("url"), F.col("final"), F.col("html"), "example.com").alias("verdict"))


@query("SELECT count(*) AS files, count(*) FILTER (WHERE doc_id % 3 = 0) AS duplicate_headings, CASE WHEN count(*) < 80 OR count(*) FILTER (WHERE doc_id % 3 = 0) > 0 THEN 'abnormal' ELSE 'normal' END AS status FROM documents")
def repeated_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page says its heading again, in capitals."""
    title = F.concat(F.lit("Page "), number("doc_id"))
    again = F.when(F.col("doc_id") % 3 == 0, F.upper(title)).otherwise("Other")
    pages = table(spark, sf_dir, "documents").select(F.concat(F.lit("# "), title, F.lit("\n\n## "), again, F.lit("\n\ntext")).alias("content"))
    return markdown.artifact_census(pages).select("files", "duplicate_headings", "status")


# --- release and provenance --------------------------------------------------------------------------------------------


@query(
    """SELECT doc_id, concat_ws(chr(10), CASE WHEN doc_id % 2 = 0 THEN '> **Source:** https://x/' || doc_id END, '> **Kind:** ' || CASE WHEN lang = 'en' THEN 'wiki_page' WHEN lang = 'fr' THEN 'authored' ELSE 'c_source' END,
  '> **Method:** ' || CASE WHEN lang = 'en' THEN 'scraped from the wiki' WHEN lang = 'fr' THEN 'hand-authored' ELSE 'extracted from source' END, CASE WHEN doc_id % 3 = 0 THEN '> **Commit:** ' || left(sha256(text), 10) END, '> **Normalized:** 2026-03-09') || chr(10) || chr(10) || 'Body' AS content FROM documents"""
)
def provenance_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.when(F.col("lang") == "en", "wiki_page").when(F.col("lang") == "fr", "authored").otherwise("c_source")
    d = table(spark, sf_dir, "documents").select("doc_id", origin.alias("origin_type"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://x/"), number("doc_id"))).alias("source_url"), F.when(F.col("doc_id") % 3 == 0, text.body_hash(F.col("text"), 10)).otherwise("").alias("source_commit"), F.when(F.col("doc_id") % 5 == 0, "2026-03-09T10:00:00Z").alias("last_pipeline_run"), F.lit("Body").alias("body"))
    return release.with_provenance(d, "2026-03-09T23:59:59Z").select("doc_id", "content")


@query("SELECT doc_id, '- [Document ' || doc_id || '](./' || doc_id || '.md)' || coalesce(CASE WHEN quality = 1 THEN ': Routing' END, CASE WHEN toxic = 0 THEN ': Summary' END, CASE WHEN lang = 'en' THEN ': Description' END, '') AS line FROM documents LEFT JOIN labels USING (doc_id)")
def skeleton_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", release.skeleton_line(F.concat(F.lit("Document "), number("doc_id")), F.concat(number("doc_id"), F.lit(".md")), F.when(F.col("quality") == 1, "Routing"), F.when(F.col("toxic") == 0, " Summary ").otherwise(" "), F.when(F.col("lang") == "en", "Description")).alias("line"))


@query("SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN 'aaaaaaa' WHEN source = 'src2' THEN 'bbbbbbb' END AS \"commit\" FROM documents")
def module_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources belong to one repository, one to another; a fourth's repository has no commit."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("module"))
    return release.with_commit(d, {"src0": "core", "src1": "core", "src2": "web", "src3": "gone"}, {"core": "aaaaaaa", "web": "bbbbbbb"}).select("doc_id", "commit")


@query("WITH m AS (SELECT source, CASE WHEN source IN ('src0', 'src1') THEN 'core' ELSE 'more' END AS c, CAST(sum(n_chars) AS BIGINT) AS t FROM documents GROUP BY source), l AS (SELECT c, sum(t) AS t, string_agg('- [' || source || '](./' || source || '/llms.txt): about ' || source || ' (~' || t || ' tokens)', chr(10) ORDER BY source) AS l FROM m GROUP BY c) SELECT CAST(sum(t) AS BIGINT) AS tokens, string_agg('## ' || c || chr(10) || l, chr(10) || chr(10) ORDER BY c) AS index FROM l")
def root_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("module")).agg(F.sum("n_chars").alias("tokens"))
    return release.root_index(m.select("module", F.when(F.col("module").isin("src0", "src1"), "core").otherwise("more").alias("category"), F.concat(F.lit("about "), "module").alias("description"), "tokens"))


@query("SELECT doc_id || '.md' AS path, '- [' || doc_id || '.md](./' || doc_id || '.md) (~' || n_chars || ' tokens)' AS line FROM documents")
def flat_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.catalogue(table(spark, sf_dir, "documents").select(F.concat(number("doc_id"), F.lit(".md")).alias("path"), F.col("n_chars").alias("token_count")))


# --- column functions --------------------------------------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'b@x.org' ELSE 'joe' || doc_id || '@example.org' END AS address, CASE doc_id % 3 WHEN 0 THEN '<' || doc_id || '@x> <y@z>' WHEN 1 THEN doc_id || '@x' ELSE '' END AS ids, CASE WHEN doc_id % 4 = 0 THEN '9999-12-31T23:59:59' ELSE '2026-01-01' END AS sort_date, CASE WHEN doc_id % 5 = 0 THEN 'package/a/' || doc_id || '.mk lib/x.c' ELSE '' END AS files FROM documents")
def mail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses, message ids, sort dates and file references made from the numbers of the documents."""
    k, n = F.col("doc_id"), number("doc_id")
    address = F.when(k % 2 == 0, F.lit("\t<b@x.org>\n")).otherwise(F.concat(F.lit(" joe"), n, F.lit(" at example.org ")))
    ids = F.when(k % 3 == 0, F.concat(F.lit("<"), n, F.lit("@x> <y@z>"))).when(k % 3 == 1, F.concat(F.lit(" "), n, F.lit("@x\n")))
    files = F.when(k % 5 == 0, F.concat(F.lit("see package/a/"), n, F.lit(".mk, (lib/x.c) and other/y.c"))).otherwise("none")
    return table(spark, sf_dir, "documents").select("doc_id", text.email(address).alias("address"), F.array_join(text.message_ids(ids), " ").alias("ids"), text.sort_date(F.when(k % 4 != 0, "2026-01-01")).alias("sort_date"), F.array_join(text.file_references(files), " ").alias("files"))


@query(
    """SELECT doc_id, doc_id % 4 = 0 AS iso, doc_id % 3 <> 2 AS commit_ok, doc_id % 5 = 0 AS payload, CASE WHEN doc_id % 2 = 0 THEN 'a b' ELSE '' END AS topics FROM documents"""
)
def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, commit ids, payloads and topics, right and wrong in turn."""
    k, n = F.col("doc_id"), number("doc_id")
    pick = lambda m, *options: F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (k % m + 1).cast("int"))
    iso = pick(4, "2026-02-28T10:00:00.123456Z", "2026-02-30", "2026-13-01", "soon")
    commit = pick(3, F.concat(F.lit("abcdef0"), n), F.lit(" 1234567 "), F.lit("xyz1234"))
    summary = pick(5, "A summary of twenty characters.", "short", "A summary with <script> in it, long.", "A summary with \u0001 in it, long enough.", "")
    topics = F.when(k % 2 == 0, F.array(F.lit(" a "), F.lit(""), F.lit("b"))).otherwise(F.array(F.lit(" ")))
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", store.is_iso(iso).alias("iso"), text.is_commit(commit).alias("commit_ok"), text.payload_ok(summary, F.lit("Always."), F.array(F.lit("t"))).alias("payload"), F.array_join(text.topics(topics), " ").alias("topics"))


@query(
    """WITH RECURSIVE m AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST((doc_id * 7 + 3) % (n + 5) AS VARCHAR) END AS parent FROM documents, (SELECT count(*) AS n FROM documents)),
linked AS (SELECT a.id, b.id AS parent FROM m a LEFT JOIN m b ON a.parent = b.id),
climb AS (SELECT id, id AS node, CAST([] AS VARCHAR[]) AS seen, 0 AS depth FROM linked UNION ALL SELECT c.id, l.parent, list_append(c.seen, l.parent), c.depth + 1 FROM climb c JOIN linked l ON c.node = l.id WHERE l.parent IS NOT NULL AND NOT list_contains(c.seen, l.parent))
SELECT id, arg_max(node, depth) AS root FROM climb GROUP BY id"""
)
def cyclic_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages, each an answer to another by a rule that makes long chains, cycles and missing parents."""
    d = table(spark, sf_dir, "documents")
    n = d.agg(F.count("*").alias("n"))
    parent = F.when(F.col("doc_id") % 11 != 0, ((F.col("doc_id") * 7 + 3) % (F.col("n") + 5)).cast("string"))
    return threads.roots(d.join(F.broadcast(n)).select(number("doc_id").alias("id"), parent.alias("parent")))


@query(
    f"""WITH {STORE_SQL}, e AS (SELECT b.module, b.slug, b.content_hash, d.body_hash FROM base b JOIN docs d USING (module, slug)) SELECT slug, content_hash IS NOT NULL AND content_hash <> body_hash AS stale FROM e"""
)
def cross_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base records against their documents' hashes."""
    found = store.lookup(semantic(spark, sf_dir), layers(spark, sf_dir)[0], layers(spark, sf_dir)[0].limit(0))
    return found.where("record is not null").select("slug", (F.col("status") == "stale").alias("stale"))


@query("SELECT CAST(conv_id AS VARCHAR) AS thread_id, 1 AS n, count(DISTINCT role) AS source_files FROM conversations GROUP BY conv_id")
def thread_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads by the number of files that their messages come from, a file for each role."""
    return threads.rollup(as_messages(spark, sf_dir).withColumn("source_file", F.col("sender"))).select("thread_id", F.lit(1).alias("n"), "source_files")


@query("WITH t AS (SELECT conv_id, count(DISTINCT role) AS f, count(*) AS n FROM conversations GROUP BY conv_id) SELECT count(*) AS threads_created, count(*) FILTER (WHERE f > 1) AS cross_month_threads, CAST(sum(n) AS BIGINT) AS messages_threaded FROM t")
def thread_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.thread_totals(threads.rollup(as_messages(spark, sf_dir).withColumn("source_file", F.col("sender"))))


# --- sources of code, links, reports -----------------------------------------------------------------------------------


@query("SELECT 'f' || item_id || '.c' AS path, CAST(0 AS INTEGER) AS ordinal, 'About ' || item_id || '.' || chr(10) || trim(text) AS comment, 'int f' || item_id || '(void)' AS declares FROM benchmark UNION ALL SELECT 'f' || item_id || '.c', 1, 'Second.', 'void g' FROM benchmark")
def documented_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as the comments of C sources."""
    n = number("item_id")
    content = F.concat(F.lit("#include <x.h>\n/**\n * About "), n, F.lit(".\n * "), F.trim("text"), F.lit("\n */\nint f"), n, F.lit("(void)\n{\n}\n/* plain */\n/** Second. */ void g;\n"))
    root = tree(spark, sf_dir, "sources", lambda: table(spark, sf_dir, "benchmark").select(F.concat(F.lit("f"), n, F.lit(".c")).alias("path"), content.alias("content")))
    files = corpus.whole_files(spark, root, "*.c")
    return corpus.documented(files.select(corpus.relative(F.col("path"), root).alias("path"), "content"))


@query("SELECT 'p' || item_id || '/Makefile' AS path, unnest(['PKG_NAME', 'PKG_VERSION']) AS key, unnest(['p' || item_id, '2.' || item_id]) AS value FROM benchmark")
def package_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as package makefiles; the second version counts."""
    n = number("item_id")
    content = F.concat(F.lit("include x.mk\nPKG_NAME:=p"), n, F.lit("\nPKG_VERSION:=1."), n, F.lit("\nPKG_VERSION := 2."), n, F.lit("\nOTHER:=PKG_NAME\n"))
    root = tree(spark, sf_dir, "packages", lambda: table(spark, sf_dir, "benchmark").select(F.concat(F.lit("p"), n, F.lit("/Makefile")).alias("path"), content.alias("content")))
    files = corpus.whole_files(spark, root, "Makefile")
    return corpus.makefile_metadata(files.select(corpus.relative(F.col("path"), root).alias("path"), "content"))


def _scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as JavaScript: a documented function each, with types by the item's number."""
    n, k = number("item_id"), F.col("item_id")
    kind = F.element_at(F.array(F.lit("string"), F.lit("?number"), F.lit("Array<string|number>"), F.lit("Object<string, Promise<bool>>")), (k % 4 + 1).cast("int"))
    content = F.concat(F.lit("/**\n * "), F.regexp_replace(F.trim("text"), r"\s*[@*/].*", ""), F.lit("\n * @memberof Lib.part"), (k % 3).cast("string"), F.lit("\n * @param {"), kind, F.lit("} first - The first\n * @param {function} [last]\n * @returns {"), kind, F.lit("}\n */\nfunction run"), n, F.lit("(first, last) {\n}\n"))
    root = tree(spark, sf_dir, "scripts", lambda: table(spark, sf_dir, "benchmark").select(F.concat(F.lit("s"), n, F.lit(".js")).alias("path"), content.alias("content")))
    files = corpus.whole_files(spark, root, "*.js")
    return extractors.javascript(files.select(corpus.relative(F.col("path"), root).alias("path"), "content"))


SCRIPTS_SQL = "s AS (SELECT item_id, text, ['string', 'number | null', '(string | number)[]', 'Record<string, Promise<boolean>>'][item_id % 4 + 1] AS kind FROM benchmark)"


@query(f"WITH {SCRIPTS_SQL} SELECT 's' || item_id || '.js' AS path, 'run' || item_id AS name, 'Lib.part' || item_id % 3 AS memberof, 'first: ' || kind || ', last?: (...args: any[]) => any' AS params, kind AS returns, sha256(trim(regexp_replace(trim(text), '\\s*[@*/].*', ''), ' ' || chr(10) || chr(9) || chr(13))) AS description FROM s")
def documented_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the comments of the scripts say, with types in TypeScript."""
    shown = F.array_join(F.transform("params", lambda p: F.concat(p["name"], F.when(p["optional"], "?: ").otherwise(": "), p["type"])), ", ")
    return _scripts(spark, sf_dir).select("path", "name", "memberof", shown.alias("params"), "returns", F.sha2("description", 256).alias("description"))


@query(
    f"""WITH {SCRIPTS_SQL}, l AS (SELECT item_id % 3 AS m, string_agg('        function run' || item_id || '(first: ' || kind || ', last?: (...args: any[]) => any): ' || kind || ';', chr(10) ORDER BY 'run' || item_id) AS body FROM s GROUP BY 1)
SELECT 'declare namespace Lib {{' || chr(10) || string_agg('    namespace part' || m || ' {{' || chr(10) || body || chr(10) || '    }}', chr(10) ORDER BY m) || chr(10) || '}}' || chr(10) AS source FROM l"""
)
def typed_declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declarations of the scripts' functions, a namespace for each part of the library."""
    return release.typed_declarations(_scripts(spark, sf_dir), "Lib")


@query(
    "SELECT 'c' || item_id || '/network' AS path, CAST(unnest([0, 0, 0, 1]) AS INTEGER) AS section, unnest(['interface', 'interface', 'interface', 'rule']) AS type, unnest(['i' || item_id, 'i' || item_id, 'i' || item_id, NULL]) AS name, unnest(['option', 'list', 'list', 'option']) AS kind, unnest(['mtu', 'dns', 'dns', 'words']) AS key, unnest(['15' || item_id, 'a b', item_id::VARCHAR, replace(left(split_part(text, chr(10), 1), 30), chr(39), '')]) AS value FROM benchmark"
)
def config_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as configurations: an option that is set twice, a list, and a section without a name whose option quotes the item."""
    n = number("item_id")
    content = F.concat(F.lit("# c\nconfig interface 'i"), n, F.lit("'\n\toption mtu 1\n\toption mtu '15"), n, F.lit("'\n\tlist dns 'a b'\n\tlist dns "), n, F.lit("\n\nconfig rule\n\toption words '"), F.replace(F.left(F.substring_index("text", "\n", 1), F.lit(30)), F.lit("'"), F.lit("")), F.lit("'\n"))
    root = tree(spark, sf_dir, "configs", lambda: table(spark, sf_dir, "benchmark").select(F.concat(F.lit("c"), n, F.lit("/network")).alias("path"), content.alias("content")))
    files = corpus.whole_files(spark, root, "network")
    return extractors.uci(files.select(corpus.relative(F.col("path"), root).alias("path"), "content")).drop("ordinal")


@query("SELECT 'cook' AS module, 'authored' AS origin_type, 'page-' || item_id AS slug, sha256(text) AS content, CASE WHEN item_id % 3 > 0 THEN 'Page ' || item_id END AS title FROM benchmark")
def cookbook_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as authored pages; every third has no header."""
    n = number("item_id")
    header = F.when(F.col("item_id") % 3 > 0, F.concat(F.lit("---\ntitle: Page "), n, F.lit("\nlevel: easy\n---\n"))).otherwise("")
    root = tree(spark, sf_dir, "cookbook", lambda: table(spark, sf_dir, "benchmark").select(F.concat(F.lit("cook/page-"), n, F.lit(".md")).alias("path"), F.concat(header, "text").alias("content")))
    return corpus.cookbook(spark, root).select("module", "origin_type", "slug", F.sha2("content", 256).alias("content"), F.try_element_at("metadata", F.lit("title")).alias("title"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'fs mod' || doc_id % 10 ELSE 'mod' || doc_id % 10 END AS imports, CASE doc_id % 3 WHEN 0 THEN 'bash' WHEN 1 THEN 'json' ELSE 'ucode' END AS lang, 'import * as mod' || doc_id % 10 || ' from ''mod' || doc_id % 10 || ''';' || chr(10) || 'mod' || doc_id % 10 || '.run(mod' || doc_id % 10 || '.const.X);' AS fixed FROM documents")
def script_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code made from the documents' numbers: what it imports, the language of its fence, an import of a reserved name put right."""
    from pyspark.sql.functions import pandas_udf

    own = F.concat(F.lit("mod"), (F.col("doc_id") % 10).cast("string"))
    code = F.concat(F.lit("import { run, const } from '"), own, F.lit("';\nrun(const.X);"))
    imports = F.concat(code, F.when(F.col("doc_id") % 2 == 0, "\nimport 'fs';").otherwise(""))
    fence = F.element_at(F.array(F.lit("$ ls -l"), F.lit('{"a": 1}'), F.lit("let x = 1;")), (F.col("doc_id") % 3 + 1).cast("int"))
    named = pandas_udf(lambda s: s.map(lambda x: markdown.code_blocks(markdown.normalise_fences(f"```\n{x}\n```\n", "ucode"))[0][0]), "string")
    right = pandas_udf(lambda s: s.map(markdown.namespaced_imports), "string")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(markdown.imports(imports), " ").alias("imports"), named(fence).alias("lang"), right(code).alias("fixed"))


HINTS_SQL = "MAP {" + ", ".join(f"{lit(k)}: [{', '.join(map(lit, v))}]" for k, v in fixed.SEARCH_HINTS.items()) + "}"


@query(f"WITH c AS (SELECT doc_id, [{lit('networking')}, CASE WHEN doc_id % 2 = 0 THEN {lit('build-system')} ELSE 'uncategorized' END] AS cats FROM documents) SELECT doc_id, array_to_string(list_concat(flatten(list_transform(cats, lambda k: coalesce({HINTS_SQL}[k], []))), CASE WHEN doc_id % 3 = 0 THEN ['grep -R \"a.c\" .', 'grep -R \"b.h\" .'] ELSE [] END), chr(10)) AS hints FROM c")
def search_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array(F.lit("networking"), F.when(F.col("doc_id") % 2 == 0, "build-system").otherwise("uncategorized"))
    named = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("x/a.c"), F.lit("b.h"), F.lit("y/a.c"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.search_hints(found, named), "\n").alias("hints"))


@query(
    """WITH m AS (SELECT conv_id, turn, text || ' see package/p' || conv_id % 3 || '/t' || turn || '.mk and c0ffee' || turn || ' again' AS body FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS thread_id, array_to_string(list_sort(list_distinct(list('package/p' || conv_id % 3 || '/t' || turn || '.mk'))), ' ') AS files, array_to_string(list_sort(list_distinct(list('c0ffee' || turn))), ' ') AS commits, array_to_string(list(turn ORDER BY turn DESC), ' ') AS refs,
  min(turn) AS first_turn, max(turn) AS last_turn FROM m GROUP BY conv_id"""
)
def thread_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a thread gathers from its messages: files, commits, references in the order of their dates (here the turns backwards), the first and last date."""
    m = as_messages(spark, sf_dir)
    body = F.concat("body", F.lit(" see package/p"), (F.col("root").cast("long") % 3).cast("string"), F.lit("/t"), number("byte_offset"), F.lit(".mk and c0ffee"), number("byte_offset"), F.lit(" again"))
    only = F.lit(" see ")
    dated = m.withColumn("body", body).withColumn("tail", F.concat(only, F.element_at(F.split("body", " see "), -1)))
    dated = dated.withColumn("files", text.file_references(F.col("tail"))).withColumn("commits", text.commits(F.col("tail"))).withColumn("date_iso", F.format_string("2026-01-%02dT00:00:00", 28 - F.col("byte_offset").cast("int")))
    t = threads.rollup(dated)
    turn = lambda d: F.lit(28) - F.substring(d, 9, 2).cast("long")
    return t.select("thread_id", F.array_join("files", " ").alias("files"), F.array_join("commits", " ").alias("commits"), F.array_join(F.transform("source_refs", lambda x: x["byte_offset"].cast("string")), " ").alias("refs"), turn(F.col("last_date")).alias("first_turn"), turn(F.col("first_date")).alias("last_turn"))


def _lessons(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = as_messages(spark, sf_dir)
    return threads.lessons(m, threads.passing(threads.rollup(m), LOW))


@query(
    f"""WITH {LESSONS_SQL} SELECT categories[1] AS category, concat_ws(chr(10), '### ' || title, '', '- Score: ' || format('{{}}', score), '- Completeness: ' || level, '- Source: conversations', '- Archive: ', '- Root message: ' || thread_id || '-0',
  chr(10) || 'Problem:' || chr(10) || '> ' || problem, chr(10) || 'Correction:' || chr(10) || '> ' || coalesce(fix, 'None in the archive; look for the right way in the code.'), chr(10) || '---' || chr(10)) AS entry FROM titled"""
)
def lesson_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the lesson index."""
    return sinks.lesson_entries(_lessons(spark, sf_dir)).select("category", "entry")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as lessons of three categories with hints and snippets made from their numbers."""
    k, n = F.col("item_id"), number("item_id")
    category = F.concat(F.lit("c"), (k % 3).cast("string"))
    hints = F.array(F.concat(F.lit("h"), (k % 5).cast("string")), F.concat(F.lit("g"), (k % 2).cast("string")))
    snippet = F.struct(F.concat(F.lit("word"), (k % 4).cast("string"), F.lit(" the common word")).alias("snippet"))
    return table(spark, sf_dir, "benchmark").select(
        F.format_string("lesson-%04d", k).alias("lesson_id"), F.concat(F.lit("Title "), n).alias("title"), (k * 7 % 50).cast("int").alias("score_cents"), (k * 7 % 50 / 100.0).alias("score"),
        F.array(category).alias("categories"), hints.alias("codebase_search_hints"), snippet.alias("problem"),
    )


def _lines(spark: SparkSession, name: str, write) -> DataFrame:
    """(n, line) of a report that ``write(path)`` puts into a file."""
    path = f"{lineage.shared_dir(spark)}/{name}-{uuid.uuid4().hex}.md"
    lineage._written.append((spark, path))
    write(path)
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))


SCORED_SQL = "l AS (SELECT item_id, 'lesson-' || printf('%04d', item_id) AS lesson_id, 'Title ' || item_id AS title, CAST(item_id * 7 % 50 AS INTEGER) AS cents, 'c' || item_id % 3 AS category FROM benchmark)"


@query(
    f"""WITH {SCORED_SQL}, h AS (SELECT category, unnest(['h' || item_id % 5, 'g' || item_id % 2]) AS hint, unnest([0, 1]) AS place, cents, title, lesson_id FROM l),
f AS (SELECT category, hint, min((-cents, lower(title), lesson_id, place)) AS seen FROM h GROUP BY category, hint),
s AS (SELECT string_agg('## ' || category || chr(10) || chr(10) || '```bash' || chr(10) || hints || chr(10) || '```' || chr(10), chr(10) ORDER BY category) AS body FROM (SELECT category, string_agg(hint, chr(10) ORDER BY seen) AS hints FROM f GROUP BY category)),
t AS (SELECT string_split('# Codebase search guide' || chr(10) || chr(10) || body, chr(10)) AS lines FROM s)
SELECT CAST(unnest(range(0, len(lines))) AS INTEGER) AS n, unnest(lines) AS line FROM t"""
)
def search_guide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the written guide: every category's hints in the order in which its lessons bring them."""
    return _lines(spark, "guide", lambda path: sinks.search_guide(_scored(spark, sf_dir), path))


@query(
    f"""WITH {SCORED_SQL}, tokens AS (SELECT category, unnest([category, 'word' || item_id % 4, 'common', 'word']) AS signal, unnest([0, 1, 2, 3]) AS place, cents, title, lesson_id FROM l),
counted AS (SELECT category, signal, count(*) AS n, min((-cents, lower(title), lesson_id, place)) AS seen FROM tokens GROUP BY category, signal),
signals AS (SELECT category, string_agg(signal, ', ' ORDER BY n DESC, seen) AS s FROM counted GROUP BY category),
best AS (SELECT category, title, cents / 100.0 AS score, row_number() OVER (PARTITION BY category ORDER BY cents DESC, lower(title), lesson_id) AS rank, count(*) OVER (PARTITION BY category) AS n FROM l),
parts AS (SELECT category, any_value(n) AS n, string_agg('- ' || title || ' (' || format('{{}}', score) || ')', chr(10) ORDER BY rank) AS top FROM best WHERE rank <= 5 GROUP BY category),
body AS (SELECT string_agg('## ' || category || chr(10) || chr(10) || '- Lesson candidates: ' || n || chr(10) || '- Common signals: ' || s || chr(10) || chr(10) || top || chr(10), chr(10) ORDER BY category) AS b, sum(n) AS total, count(*) AS c FROM parts JOIN signals USING (category)),
t AS (SELECT string_split('# Common problems' || chr(10) || chr(10) || '- Lesson candidates: ' || CAST(total AS BIGINT) || chr(10) || '- Categories: ' || c || chr(10) || chr(10) || b, chr(10)) AS lines FROM body)
SELECT CAST(unnest(range(0, len(lines))) AS INTEGER) AS n, unnest(lines) AS line FROM t"""
)
def problem_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the written report: counts, signals and the five best lessons of each category. (A top-k report.)"""
    lessons = _scored(spark, sf_dir)
    return _lines(spark, "problems", lambda path: sinks.problem_report(threads.common_signals(lessons), lessons, path))


@query(
    """WITH s AS (SELECT 'run-' || printf('%02d', n_nationkey % 7) || CASE WHEN n_nationkey >= 7 THEN chr(CAST(97 + n_nationkey // 7 AS INTEGER)) ELSE '' END || '-' || lower(n_name) AS stage, n_nationkey FROM nation WHERE NOT contains(n_name, ' '))
SELECT '03' AS wanted, stage FROM s WHERE stage LIKE 'run-03-%' UNION ALL SELECT '02b', stage FROM s WHERE stage LIKE 'run-02b-%'
UNION ALL SELECT '99', 'none' UNION ALL SELECT 'all', stage FROM s"""
)
def selected_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as stages: by an exact id, by one with a letter, by one that none has, and all."""
    rows = table(spark, sf_dir, "nation").where(~F.col("n_name").contains(" ")).orderBy("n_nationkey").collect()  # a reference table of 25 rows
    stages = [f"run-{r['n_nationkey'] % 7:02}{chr(97 + r['n_nationkey'] // 7) if r['n_nationkey'] >= 7 else ''}-{r['n_name'].lower()}" for r in rows]
    out = [("all", s) for s in runs.select_stages(stages, None)]
    for wanted in ("03", "02b", "99"):
        try:
            out += [(wanted, s) for s in runs.select_stages(stages, wanted)]
        except ValueError:
            out.append((wanted, "none"))
    return spark.createDataFrame(out, "wanted string, stage string")


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'refused' WHEN 1 THEN 'refused' WHEN 2 THEN 'refused' WHEN 3 THEN 'refused' ELSE 'safe' END AS verdict FROM pages")
def guarded_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of trees: equal, one inside the other, the other inside the one, a blank path, and two apart."""
    own, other = F.concat(F.lit("/data/"), number("page_id")), F.concat(F.lit("/other/"), number("page_id"))
    target = F.element_at(F.array(own, F.concat(own, F.lit("/deeper/tree")), F.lit("/data"), F.lit("  "), other), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", F.when(runs.trees_apart(own, target), "safe").otherwise("refused").alias("verdict"))
