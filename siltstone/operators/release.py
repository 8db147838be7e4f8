"""What a release is put together from: symbol links, warnings, declarations, routing indexes, banners."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from siltstone.functions import markdown, text

SYMBOL = r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*"


def mentions(docs: DataFrame, symbols: DataFrame) -> DataFrame:
    """(doc key columns of docs, symbol and its columns): the known symbols that a document's prose names, each once; fenced and inline code don't count.

    Documents are cut into distinct words first, so what is joined are words and
    not texts, and no side need be small.
    """
    keys = [c for c in docs.columns if c != "content"]
    prose = F.regexp_replace(markdown.without_fences(F.col("content")), "`[^`\n]*`", " ")
    words = docs.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(prose, F.lit(SYMBOL), F.lit(0)))).alias("symbol"))
    return words.join(symbols, "symbol")


@pandas_udf(T.StringType())
def _linked(contents: pd.Series, targets: pd.Series) -> pd.Series:
    return pd.Series([markdown.link_symbols(c, dict(t) if t is not None else {}) for c, t in zip(contents, targets, strict=True)], dtype=object)


def link(docs: DataFrame, registry: DataFrame, key: str = "path") -> DataFrame:
    """(key, content) with the first mention of every registered symbol (symbol, target) as a link; a document does not link to itself."""
    found = mentions(docs.select(key, "content"), registry).where(F.col("target") != F.col(key))
    targets = found.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "target")))).alias("targets"))
    return docs.join(targets, key, "left").select(*[c for c in docs.columns if c != "content"], _linked("content", "targets").alias("content"))


def warn_of_deprecated(docs: DataFrame, registry: DataFrame, key: str = "path") -> DataFrame:
    """Documents that name a deprecated symbol (symbol, deprecated) get a warning in front that lists those symbols."""
    named = mentions(docs.select(key, "content"), registry.where("deprecated").select("symbol"))
    listed = named.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("symbol")), ", ").alias("deprecated"))
    warning = F.concat(F.lit("> [!WARNING]\n> Deprecated: "), "deprecated", F.lit("\n\n"))
    return docs.join(listed, key, "left").select(*[c for c in docs.columns if c != "content"], F.concat(F.coalesce(warning, F.lit("")), "content").alias("content"))


def declarations(symbols: DataFrame) -> DataFrame:
    """(module, name, parameters: array of struct(name, optional)) to (module, source): a TypeScript module of functions in the order of their names."""
    plain = lambda p: F.concat(F.regexp_replace(p["name"], r"[^\w$]", "_"), F.when(p["optional"], "?: any").otherwise(": any"))
    line = F.concat(F.lit("    export function "), "name", F.lit("("), F.array_join(F.transform("parameters", plain), ", "), F.lit("): any;"))
    lines = symbols.select("module", F.struct("name", line.alias("line")).alias("x")).distinct()
    body = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n")
    return lines.groupBy("module").agg(F.concat(F.lit('declare module "'), F.first("module"), F.lit('" {\n'), body, F.lit("\n}")).alias("source"))


def typed_declarations(symbols: DataFrame, root: str) -> DataFrame:
    """Documented symbols (kind, name, memberof, params, returns) to one row, ``source``: a TypeScript declaration of the namespace ``root``.

    Namespaces inside it are named by their path, classes hold their methods and
    members.  Symbols that belong to nothing, or to a path outside the root, stand in
    the root under their own names; what belongs to a class that is not documented
    makes a namespace of its name.  Order is by path and name; of a repeated symbol
    the first by its line stays.
    """
    safe = lambda c: F.regexp_replace(c, r"[^\w$]", "_")
    shown = lambda p: F.concat(F.when(p["rest"], "...").otherwise(""), safe(p["name"]), F.when(p["optional"] & ~p["rest"], "?").otherwise(""), F.lit(": "), F.when(p["rest"] & ~p["type"].endswith("[]"), "any[]").otherwise(p["type"]))
    # TypeScript wants what is optional behind what is not
    late = F.filter("params", lambda p: p["optional"] & ~p["rest"])
    ordered = F.concat(F.filter("params", lambda p: ~p["optional"] & ~p["rest"]), late, F.filter("params", lambda p: p["rest"]))
    arguments = F.concat(F.lit("("), F.array_join(F.transform(ordered, shown), ", "), F.lit("): "))
    result = F.coalesce("returns", F.lit("any"))
    inside = F.regexp_replace(F.coalesce("memberof", F.lit("")), "^" + root.replace(".", "[.]") + r"(?:[.]|$)", "")
    at = F.when((F.col("kind") == "namespace") | (F.col("kind") == "class"), F.concat_ws(".", F.nullif(inside, F.lit("")), F.when((F.col("name") != root), F.col("name")))).otherwise(inside)
    rows = symbols.where("name is not null").select("kind", F.col("name"), at.alias("at"), arguments.alias("arguments"), result.alias("result"))
    classes = rows.where("kind = 'class'").select("at", F.first("arguments").over(W.partitionBy("at").orderBy("arguments")).alias("make")).distinct()
    rows = rows.join(classes, "at", "left")
    in_class = F.col("make").isNotNull()
    line = (
        F.when(F.col("kind").isin("namespace", "class"), F.lit(None))
        .when(F.col("kind") == "typedef", F.when(in_class, None).otherwise(F.concat(F.lit("type "), safe(F.col("name")), F.lit(" = "), "result", F.lit(";"))))
        .when(F.col("kind") == "function", F.concat(F.when(in_class, "").otherwise("function "), safe(F.col("name")), "arguments", "result", F.lit(";")))
        .otherwise(F.concat(F.when(in_class, "").otherwise("const "), safe(F.col("name")), F.lit(": "), "result", F.lit(";")))
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("name", line.alias("line")))), lambda x: F.concat(F.lit("        "), x["line"])), "\n")
    blocks = rows.groupBy("at").agg(body.alias("body"), F.first("make").alias("make"))
    last, path = F.element_at(F.split("at", r"[.]"), -1), F.regexp_replace("at", r"(?:^|[.])[^.]+$", "")
    new = F.concat(F.lit("        constructor"), F.regexp_replace("make", r"\): $", ");"))
    opened = (
        F.when(F.col("at") == "", F.regexp_replace("body", "(?m)^        ", "    "))
        .when(F.col("make").isNull(), F.concat(F.lit("    namespace "), "at", F.lit(" {\n"), "body", F.lit("\n    }")))
        .when(path == "", F.concat(F.lit("    class "), last, F.lit(" {\n"), F.concat_ws("\n", new, F.nullif("body", F.lit(""))), F.lit("\n    }")))
        .otherwise(F.concat(F.lit("    namespace "), path, F.lit(" { class "), last, F.lit(" {\n"), F.concat_ws("\n", new, F.nullif("body", F.lit(""))), F.lit("\n    } }")))
    )
    text_ = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", opened.alias("block")))), lambda x: x["block"]), "\n")
    return blocks.agg(F.concat(F.lit(f"declare namespace {root} {{\n"), text_, F.lit("\n}\n")).alias("source"))


def banner(commits: dict[str, str]) -> str:
    """``repository@commit`` of every repository, joined by commas."""
    return ", ".join(f"{name}@{commit}" for name, commit in commits.items())


def missing_names(environment: dict[str, str | None]) -> list[str]:
    """The names of a version banner that have no value, in their order."""
    return [name for name, value in environment.items() if not (value or "").strip()]


def inject_summary(docs: DataFrame) -> DataFrame:
    """Pages (frontmatter, body, ai_summary, ai_when_to_use, ai_related_topics) as ``content`` with the three fields in their header.

    The header's lines stay in their order: a field that is there is replaced in
    its place, others come at the end.  Values are written as JSON, which YAML
    reads.  A page without a summary stays as it is.
    """
    values = {"ai_summary": F.to_json(F.array("ai_summary")), "ai_when_to_use": F.to_json(F.array("ai_when_to_use"))}
    new = {k: F.concat(F.lit(f"{k}: "), F.substring(v, 2, 1 << 30).substr(F.lit(1), F.length(v) - 2)) for k, v in values.items()}
    new["ai_related_topics"] = F.concat(F.lit("ai_related_topics: "), F.to_json("ai_related_topics"))
    header = F.col("frontmatter")
    for key, line in new.items():
        there = header.rlike(rf"(?m)^{key}:")
        quoted = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        header = F.when(there, F.regexp_replace(header, F.lit(rf"(?m)^{key}:[^\n]*(?:\n[ \t-][^\n]*)*"), quoted)).otherwise(F.concat_ws("\n", header, line))
    whole = lambda h: F.concat(F.lit("---\n"), h, F.lit("\n---\n"), "body")
    return docs.withColumn("content", F.when(F.coalesce(F.trim("ai_summary"), F.lit("")) != "", whole(header)).otherwise(whole(F.col("frontmatter"))))


def with_commit(docs: DataFrame, owners: dict[str, str], commits: dict[str, str]) -> DataFrame:
    """The commit of the repository that owns each document's module; null where none does."""
    known = {m: commits[r] for m, r in owners.items() if r in commits}
    if not known:
        return docs.withColumn("commit", F.lit(None).cast("string"))
    pairs = F.create_map(*[F.lit(x) for p in known.items() for x in p])
    return docs.withColumn("commit", F.try_element_at(pairs, F.col("module")))


def skeleton_line(title: Column, file: Column, routing: Column, summary: Column, description: Column) -> Column:
    """A list entry with the short description, which a skeleton does not take from the body."""
    short = text.short_description(routing, summary, description)
    return F.concat(F.lit("- ["), title, F.lit("](./"), file, F.lit(")"), F.coalesce(F.concat(F.lit(": "), short), F.lit("")))


#: Ranks of a document's routing priority; others come after them.
PRIORITY = {"high": 0, "medium": 1, "low": 2}


def module_index(docs: DataFrame) -> DataFrame:
    """(module, file, short, token_count, routing_priority) to (module, tokens, index): the documents of each module by priority, then file."""
    rank = F.create_map(*[F.lit(x) for p in PRIORITY.items() for x in p])
    place = F.coalesce(F.try_element_at(rank, F.col("routing_priority")), F.lit(len(PRIORITY)))
    tokens = F.coalesce("token_count", F.lit(0)).cast("long")
    line = F.concat(F.lit("- ["), "file", F.lit("](./chunked-reference/"), "file", F.lit(")"), F.coalesce(F.concat(F.lit(": "), "short"), F.lit("")), F.lit(" (~"), tokens.cast("string"), F.lit(" tokens)"))
    rows = docs.select("module", tokens.alias("n"), F.struct(place.alias("place"), "file", line.alias("line")).alias("x"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n")
    head = F.concat(F.lit("# "), F.first("module"), F.lit(" module\n> **Total Context:** ~"), F.sum("n").cast("string"), F.lit(" tokens\n\n"))
    return rows.groupBy("module").agg(F.sum("n").alias("tokens"), F.concat(head, lines).alias("index"))


def root_index(modules: DataFrame) -> DataFrame:
    """(module, category, description, tokens) to one row: total tokens and the index of modules by category, then name."""
    line = F.concat(F.lit("- ["), "module", F.lit("](./"), "module", F.lit("/llms.txt)"), F.coalesce(F.concat(F.lit(": "), "description"), F.lit("")), F.lit(" (~"), F.col("tokens").cast("string"), F.lit(" tokens)"))
    by = modules.select("category", "tokens", F.struct("module", line.alias("line")).alias("x")).groupBy("category").agg(F.sum("tokens").alias("tokens"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n").alias("lines"))
    part = F.struct("category", F.concat(F.lit("## "), "category", F.lit("\n"), "lines").alias("part"))
    return by.agg(F.sum("tokens").alias("tokens"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["part"]), "\n\n").alias("index"))


def catalogue(docs: DataFrame) -> DataFrame:
    """(path, token_count) in the order of the paths, as lines of a flat listing."""
    return docs.orderBy("path").select("path", F.concat(F.lit("- ["), "path", F.lit("](./"), "path", F.lit(")"), F.lit(" (~"), F.coalesce("token_count", F.lit(0)).cast("string"), F.lit(" tokens)")).alias("line"))


def with_provenance(docs: DataFrame, now: str) -> DataFrame:
    """Pages with their provenance block in front of the body; what the body held stays as it is."""
    block = text.provenance_block(F.col("origin_type"), F.col("source_url"), F.col("source_commit"), F.coalesce("last_pipeline_run", F.lit(now)))
    return docs.withColumn("content", F.concat(block, F.lit("\n\n"), "body"))
