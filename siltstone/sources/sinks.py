"""Writers: document pairs, records, JSON lines, samples and reports.

Tables go out through Spark's writers; single small files (a README, a report)
are put together from a bounded result and written through Hadoop's file system.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.lineage import cut


def put(spark: SparkSession, path: str, content: str) -> None:
    """One file, written beside its place and then renamed over it in one step, so readers see the old one or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    final, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = final.getFileSystem(conf)
    out = fs.create(part, True)
    out.write(bytearray(content.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    whole = fs.makeQualified(final)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), conf).rename(fs.makeQualified(part), whole, over)


def put_files(files: DataFrame, root: str) -> int:
    """(path, content) as files below root, one after the other as the rows come; the number of files. For trees that people read, not for data."""
    spark = files.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(conf)
    n = 0
    for r in files.select("path", "content").toLocalIterator(prefetchPartitions=True):
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{r['path']}"), True)
        content = r["content"]
        out.write(bytearray(content if isinstance(content, (bytes, bytearray)) else (content or "").encode()))
        out.close()
        n += 1
    return n


def raw_pairs(docs: DataFrame) -> DataFrame:
    """(module, origin_type, slug, content, metadata map) to the files (path, content) of each document: the Markdown and a sidecar with its metadata and the hash of its content."""
    stem = F.concat("module", F.lit("/"), "origin_type", F.lit("-"), "slug")
    own = F.create_map(F.lit("content_hash"), text.body_hash(F.col("content"), 8), F.lit("module"), F.col("module"), F.lit("origin_type"), F.col("origin_type"), F.lit("slug"), F.col("slug"))
    kept = F.map_filter("metadata", lambda k, _: ~k.isin("content_hash", "module", "origin_type", "slug"))
    side = F.to_json(F.map_concat(own, F.coalesce(kept, F.create_map().cast("map<string,string>"))))
    body = docs.select(F.concat(stem, F.lit(".md")).alias("path"), "content")
    return body.unionByName(docs.select(F.concat(stem, F.lit(".meta.json")).alias("path"), side.alias("content")))


def raw_documents(docs: DataFrame, root: str) -> None:
    """(module, origin_type, slug, content, metadata map) as one table by module, each with the hash of its content."""
    out = docs.withColumn("content_hash", text.body_hash(F.col("content"), 8)).withColumn("file", F.concat("origin_type", F.lit("-"), "slug", F.lit(".md")))
    out.write.partitionBy("module").mode("overwrite").json(root)


def code_block(title, code, lang):
    """``# title`` and a fenced block."""
    return F.concat(F.lit("# "), title, F.lit("\n\n```"), lang, F.lit("\n"), code, F.lit("\n```\n"))


def json_lines(df: DataFrame, path: str) -> None:
    """One object a line, null fields kept."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def sample(df: DataFrame, key: str, seed: int, count: int = 10) -> DataFrame:
    """count rows in the order of a seeded hash of the key. (A sampling operator: the limit is the feature.)"""
    return df.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key).limit(count)


def samples_report(df: DataFrame, key: str, seed: int, path: str, count: int = 10) -> None:
    rows = [r[0] for r in sample(df, key, seed, count).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).collect()]
    lines = ["# QA samples", "", "Rows picked by a seeded hash for inspection by hand.", ""]
    if not rows:
        lines += ["_Nothing there._", ""]
    for i, r in enumerate(rows, 1):
        lines += [f"## Sample {i}", "", "```json", json.dumps(json.loads(r), indent=2, ensure_ascii=False), "```", ""]
    put(df.sparkSession, path, "\n".join(lines))


def bounded(df: DataFrame, most: int, *order: str) -> tuple[list, str]:
    """The first rows of a report in an order, and a line that tells how many more there are (empty if none)."""
    rows = df.orderBy(*order).limit(most).collect()
    more = df.count() - len(rows)
    return rows, f"... and {more} more" if more > 0 else ""


def check_report(found: DataFrame, errors: int = 200, warnings: int = 50) -> str:
    """Issues (store, module, slug, severity, message) as lines: so many errors, so many warnings, and how many more of each."""
    lines, found = [], cut(found, "checked")  # the checks run once
    for severity, most in (("error", errors), ("warning", warnings)):
        rows, more = bounded(found.where(F.col("severity") == severity), most, "module", "slug", "message")
        lines += [f"{severity}: {r['module']}/{r['slug']}: {r['message']}" for r in rows] + ([f"{severity}: {more}"] if more else [])
    return "\n".join(lines)


def lesson_entries(lessons: DataFrame) -> DataFrame:
    """(category, place, entry): a section of Markdown for each lesson, in the order of its category's list."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    line = lambda name, value: F.concat(F.lit(f"- {name}: "), F.coalesce(value.cast("string"), F.lit("")))
    ref = F.try_element_at("source_refs", F.lit(1))
    head = F.concat_ws("\n", F.concat(F.lit("### "), "title"), F.lit(""), line("Score", F.col("score")), line("Completeness", F.col("completeness.level")), line("Source", ref["source_file"]), line("Archive", ref["archive_url"]), line("Root message", ref["message_id"]))
    problem = F.when(some(F.col("problem.snippet")), F.concat(F.lit("\nProblem:\n> "), F.col("problem.snippet")))
    fix = F.concat(F.lit("\nCorrection:\n> "), F.when(some(F.col("fix.snippet")), F.col("fix.snippet")).otherwise("None in the archive; look for the right way in the code."))
    files = F.when(F.size("mentioned_files") > 0, F.concat(F.lit("\nFiles: "), F.array_join("mentioned_files", ", ")))
    search = F.when(F.size("codebase_search_hints") > 0, F.concat(F.lit("\nSearch:\n```bash\n"), F.array_join("codebase_search_hints", "\n"), F.lit("\n```")))
    place = F.struct((-F.col("score_cents")).alias("score"), F.lower("title").alias("title"), "lesson_id")
    return lessons.select(text.primary_category(F.col("categories")).alias("category"), place.alias("place"), F.concat_ws("\n", head, problem, fix, files, search, F.lit("\n---\n")).alias("entry"))


def lesson_index(lessons: DataFrame, path: str, label: str) -> None:
    """Every lesson under its primary category, best first: a folder of sorted parts, in the order of their names, each written by a task."""
    spark = lessons.sparkSession
    head = spark.createDataFrame([(f"# Lessons from {label}\n",)], "value string").select(F.lit("").alias("category"), F.lit(0).alias("kind"), F.lit(None).cast("struct<score:int,title:string,lesson_id:string>").alias("place"), "value")
    entries = lesson_entries(lessons)
    names = entries.select("category").distinct().select("category", F.lit(1).alias("kind"), F.lit(None).cast("struct<score:int,title:string,lesson_id:string>").alias("place"), F.concat(F.lit("## "), "category", F.lit("\n")).alias("value"))
    rows = entries.select("category", F.lit(2).alias("kind"), F.col("place").cast("struct<score:int,title:string,lesson_id:string>").alias("place"), F.col("entry").alias("value"))
    head.unionByName(names).unionByName(rows).orderBy("category", "kind", "place").select("value").write.mode("overwrite").text(path)


def readme(spark: SparkSession, path: str, title: str, bullets: list[str]) -> None:
    put(spark, path, "\n".join([f"# {title}", "", *(f"- {b}" for b in bullets)]) + "\n")


def problem_report(signals: DataFrame, lessons: DataFrame, path: str, top: int = 5) -> None:
    """Per primary category its number of lessons, its signals and its best lessons."""
    from pyspark.sql import Window as W

    category = text.primary_category(F.col("categories")).alias("category")
    counts = {r["category"]: r["n"] for r in lessons.groupBy(category).agg(F.count("*").alias("n")).collect()}
    named = {r["category"]: r["s"] for r in signals.groupBy("category").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "signal"))), lambda x: x["signal"]), ", ").alias("s")).collect()}
    best = lessons.select(category, "title", "score", "lesson_id", F.row_number().over(W.partitionBy(category).orderBy(F.desc("score_cents"), F.lower("title"), "lesson_id")).alias("rank")).where(F.col("rank") <= top).orderBy("category", "rank").collect()
    lines = ["# Common problems", "", f"- Lesson candidates: {sum(counts.values())}", f"- Categories: {len(counts)}", ""]
    for c in sorted(counts):
        lines += [f"## {c}", "", f"- Lesson candidates: {counts[c]}", f"- Common signals: {named.get(c, '')}", ""]
        lines += [f"- {r['title']} ({r['score']})" for r in best if r["category"] == c] + [""]
    put(lessons.sparkSession, path, "\n".join(lines))


def search_guide(lessons: DataFrame, path: str) -> None:
    """Per category its search hints in the order in which lessons bring them, each once."""
    place = F.struct(-F.col("score_cents"), F.lower("title"), "lesson_id")
    each = lessons.select(place.alias("place"), F.explode("categories").alias("category"), "codebase_search_hints").select("place", "category", F.posexplode("codebase_search_hints").alias("at", "hint"))
    rows = each.groupBy("category", "hint").agg(F.min(F.struct("place", "at")).alias("first")).groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "hint"))), lambda x: x["hint"]).alias("hints")).orderBy("category").collect()
    lines = ["# Codebase search guide", ""]
    for r in rows:
        lines += [f"## {r['category']}", "", "```bash", *r["hints"], "```", ""]
    put(lessons.sparkSession, path, "\n".join(lines))
