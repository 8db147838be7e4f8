"""Scans: document trees, record stores, manifests, policies, archives, scenarios.

Trees are listed and read by tasks where those reach the files (``scans``), else by
Spark's own readers, so any file system that Spark knows will do.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from siltstone.functions import markdown, mail, text
from siltstone.sources import mbox, places, scans

try:
    import yaml
except ImportError:
    yaml = None

RECORD_JSON = "slug string, module string, title string, content_hash string, ai_summary string, ai_when_to_use string, ai_related_topics array<string>, generated_at string, saved_at string, model string, pipeline_version string"


def parts(path: Column, suffix: str) -> tuple[Column, Column]:
    """(module, slug) of a path: its folder and its name without the suffix."""
    p = F.split(path, "/")
    return F.element_at(p, -2), F.regexp_replace(F.element_at(p, -1), suffix.replace(".", r"\.") + "$", "")


def whole_files(spark: SparkSession, root: str, pattern: str, recursive: bool = True) -> DataFrame:
    """(path, content as text) of the files whose name fits the pattern; bytes that are no UTF-8 are replaced."""
    return contents(spark, root, pattern, recursive).select("path", F.decode("content", "UTF-8").alias("content"))


def contents(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, content) of the files whose name fits the pattern: listed and read by tasks; where only Spark's readers reach the files, by those."""
    if places.reachable(root):
        return scans.read(spark, root, pattern, recursive)
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return found.select("path", "content")


def targets(spark: SparkSession, root: str, suffix: str = ".md") -> DataFrame:
    """(module, slug, path): the listing alone, contents are not read."""
    if places.reachable(root):
        found = scans.listed(spark, root, f"*{suffix}").select("path")
    else:
        found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(root).select("path")
    module, slug = parts(F.col("path"), suffix)
    return found.select(module.alias("module"), slug.alias("slug"), "path")


def documents(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Semantic documents (module, slug, title, body, body_hash, frontmatter, header as JSON and its common fields) and the issues (path, problem) of files that can't be read as such."""
    module, slug = parts(F.col("path"), ".md")
    files = whole_files(spark, root, "*.md").select("path", module.alias("module"), slug.alias("slug"), "content")
    read = files.select("*", markdown.frontmatter(F.col("content")).alias("frontmatter"), markdown.body(F.col("content")).alias("body"))
    read = read.select("*", markdown.header("frontmatter").alias("h")).select(*read.columns, "h.header", "h.problem")
    get = lambda k: F.get_json_object("header", f"$.{k}")
    good = read.where("problem is null").select("module", "slug", F.coalesce(F.trim(get("title")), F.lit("")).alias("title"), "body", text.body_hash(F.col("body")).alias("body_hash"), "frontmatter", "header", *[get(k).alias(k) for k in ("origin_type", "source_url", "source_commit", "last_pipeline_run", "routing_summary", "ai_summary", "description")], get("token_count").cast("long").alias("token_count"))
    return good, read.where("problem is not null").select("path", "problem")


def records(spark: SparkSession, root: str, store: str) -> DataFrame:
    """Records of a store's layer: path_module, path_slug, the fields, ``present`` (names of the fields that are there) and whether the file is readable at all."""
    module, slug = parts(F.col("path"), ".json")
    files = whole_files(spark, root, "*.json").select(module.alias("path_module"), slug.alias("path_slug"), "content")
    ok = F.try_parse_json("content").isNotNull() & F.trim("content").startswith("{")
    read = files.select("path_module", "path_slug", F.when(ok, F.from_json("content", RECORD_JSON)).alias("r"), F.when(ok, F.json_object_keys("content")).alias("present"), ok.alias("readable"))
    return read.select(F.lit(store).alias("store"), "path_module", "path_slug", "r.*", "present", F.coalesce("readable", F.lit(False)).alias("readable"))


def layer(found: DataFrame) -> DataFrame:
    """Records keyed by their place, as the store operators take them."""
    return found.drop("module", "slug", "store", "present").withColumnsRenamed({"path_module": "module", "path_slug": "slug"})


def legacy_cache(spark: SparkSession, path: str) -> DataFrame:
    """(hash, summary, when_to_use, related_topics) of an old cache: a JSON object of objects; anything else has no rows."""
    raw = spark.read.text(path, wholetext=True)
    entries = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("hash", "v")).where(F.try_parse_json("v").isNotNull() & F.trim("v").startswith("{"))
    return entries.select("hash", F.from_json("v", "summary string, when_to_use string, related_topics array<string>").alias("e")).select("hash", "e.*")


class ManifestError(ValueError):
    pass


def manifest(spark: SparkSession, paths: list[str]) -> tuple[dict, str]:
    """The first of the candidate files that is there (each candidate once), as a dict, and its path; it must be a JSON object."""
    for path in dict.fromkeys(paths):
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
            source = spark.read.text(path, wholetext=True).first()
            try:
                found = json.loads(source["value"] if source else "")
            except ValueError as e:
                raise ManifestError(f"{path} is no JSON") from e
            if not isinstance(found, dict):
                raise ManifestError(f"{path} is no object")
            return found, path
    raise ManifestError("no manifest among " + ", ".join(paths))


def commits(environment: dict[str, str | None], found: dict | None) -> dict[str, str]:
    """For each name the environment's value, else the manifest's, else ``unknown``."""
    return {name: value or (found or {}).get(name) or "unknown" for name, value in environment.items()}


def policy(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, source, identifier, match_type, reason) of an exclusion list in YAML; a missing file excludes nothing."""
    schema = "ordinal int, source string, identifier string, match_type string, reason string"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], schema)
    source = spark.read.text(path, wholetext=True).first()["value"]
    if yaml is None:
        raise RuntimeError("reading a policy needs the yaml package")
    found = yaml.safe_load(source) or {}
    rows = found if isinstance(found, list) else next((v for v in found.values() if isinstance(v, list)), [])
    return spark.createDataFrame([(i, *(str(r[k]) if r.get(k) is not None else None for k in ("source", "identifier", "match_type", "reason"))) for i, r in enumerate(rows) if isinstance(r, dict)], schema)


def archives(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, content): the bytes of all ``*.txt`` below root, named by their path under it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(root)
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    return found.select(F.element_at(F.split(F.col("path"), base, 2), -1).alias("source_file"), "content")


def messages(spark: SparkSession, root: str, range_bytes: int = mbox.RANGE) -> DataFrame:
    """(source_file, byte_offset, from_line, message) of all archives below root, by ranges of bytes; where only Spark's readers reach the files, by whole files."""
    return mbox.read(spark, root, range_bytes) if places.reachable(root) else mail.messages(archives(spark, root))


def parsed_archives(spark: SparkSession, root: str, prefixes: dict[str, str] | None = None, range_bytes: int = mbox.RANGE) -> DataFrame:
    return mail.records(messages(spark, root, range_bytes), prefixes)


SCENARIO = r"(?s)## Scenario (\d+)(.*?)(?=\n## Scenario \d+|\n---|\z)"


def scenarios(markdown_text: DataFrame, metadata: DataFrame) -> DataFrame:
    """Blocks ``## Scenario NN`` of a text column ``content``, left-joined with metadata by id."""
    block = markdown_text.select(F.explode(F.regexp_extract_all("content", F.lit(SCENARIO), F.lit(0))).alias("block"))
    rows = block.select(F.regexp_extract("block", SCENARIO, 1).alias("id"), text.strip(F.regexp_extract("block", SCENARIO, 2)).alias("body"))
    return rows.join(metadata, "id", "left")


_DECODER = json.JSONDecoder()


def split_objects(line: str) -> list[str]:
    """The JSON values that follow one another in a line, with or without white space or commas between; what can't be read ends the list."""
    out, at = [], 0
    while at < len(line):
        if line[at] in " \t\r\n,":
            at += 1
            continue
        try:
            _, end = _DECODER.raw_decode(line, at)
        except ValueError:
            break
        out.append(line[at:end])
        at = end
    return out


@pandas_udf(T.ArrayType(T.StringType()))
def _objects(lines: pd.Series) -> pd.Series:
    return pd.Series([split_objects(x or "") for x in lines], dtype=object)


def concatenated_json(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Rows of objects that were written one after the other without a break, ``}{``, or one a line; braces inside strings are left alone."""
    each = lines.select(F.explode(_objects(F.col(column))).alias("one"))
    return each.select(F.from_json("one", f"struct<{schema}>").alias("r")).where("r is not null").select("r.*")


def relative(path: Column, root: str) -> Column:
    """A file's path below a root, with forward slashes; a path outside it stays as it is."""
    clean = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "^file:/*", "/")
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    return F.when(clean.startswith(base), F.substring(clean, len(base) + 1, 1 << 30)).otherwise(clean)


C_COMMENT = r"(?s)/\*\*(.*?)\*/\s*((?:(?!/\*\*)[^\n{;])*)"


def documented(files: DataFrame) -> DataFrame:
    """(path, content) of sources to (path, ordinal, comment, declares): each ``/** */`` block without its stars, and the line that it stands before."""
    found = files.select("path", F.posexplode(F.regexp_extract_all("content", F.lit(C_COMMENT), F.lit(0))).alias("ordinal", "block"))
    comment = F.regexp_replace(F.regexp_extract("block", C_COMMENT, 1), r"(?m)^[ \t]*\*[ \t]?", "")
    return found.select("path", "ordinal", text.strip(comment).alias("comment"), F.trim(F.regexp_extract("block", C_COMMENT, 2)).alias("declares"))


def makefile_metadata(files: DataFrame) -> DataFrame:
    """(path, content) of package makefiles to (path, key, value) of their ``PKG_`` lines, the last of a key."""
    lines = files.select("path", F.posexplode(F.split("content", "\n")).alias("at", "line")).where(F.col("line").rlike(r"^PKG_[A-Z_]+\s*[:?]?="))
    pairs = lines.select("path", "at", F.regexp_extract("line", r"^(PKG_[A-Z_]+)", 1).alias("key"), F.trim(F.regexp_extract("line", r"=(.*)$", 1)).alias("value"))
    return pairs.groupBy("path", "key").agg(F.max_by("value", "at").alias("value"))


def cookbook(spark: SparkSession, root: str) -> DataFrame:
    """Authored pages as documents: the slug is the file's name, the header's fields are their metadata; pages without a header are authored too."""
    module, slug = parts(F.col("path"), ".md")
    files = whole_files(spark, root, "*.md").select("path", module.alias("module"), slug.alias("slug"), "content")
    read = files.select("module", "slug", F.coalesce(markdown.body(F.col("content")), F.col("content")).alias("content"), markdown.header(markdown.frontmatter(F.col("content"))).alias("h"))
    return read.select("module", F.lit("authored").alias("origin_type"), "slug", "content", F.coalesce(F.from_json("h.header", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("metadata"))


# What a challenge page of a bot guard says instead of the page.
CHALLENGE = r"(?i)checking your browser|enable javascript and cookies|just a moment\.\.\.|verify you are human|captcha"


def fetched_verdict(url: Column, final_url: Column, html: Column, site: str) -> Column:
    """Why a fetched page is not taken: off-site (its address is of another host), redirected (it was led to another host), challenge (a bot guard's page); else kept."""
    host = lambda u: F.lower(F.regexp_extract(u, r"^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    own = lambda h: (h == site) | h.endswith("." + site)
    return F.when(~own(host(url)), "off-site").when(final_url.isNotNull() & ~own(host(final_url)), "redirected").when(F.coalesce(html, F.lit("")).rlike(CHALLENGE), "challenge").otherwise("kept")
