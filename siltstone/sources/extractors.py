"""What sources of code document: JavaScript comments, UCI configurations, shell helpers and hotplug scripts.

Each takes (path, content) of files and gives rows; lines are taken apart by
expressions, only documentation comments, whose types nest, by a grammar in Arrow
batches (functions/types.py). A null content has no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from siltstone.functions import text, types
from siltstone.sources import corpus

SYMBOL = "description string, kind string, name string, memberof string, params array<struct<name:string,type:string,optional:boolean,rest:boolean,default:string,description:string>>, returns string, deprecated boolean"


def _symbols(comment: Column, declares: Column) -> Column:
    @pandas_udf(SYMBOL)
    def read(comments: pd.Series, heads: pd.Series) -> pd.DataFrame:
        rows = [types.documented_symbol(c or "", d or "") for c, d in zip(comments, heads, strict=True)]
        return pd.DataFrame(rows, columns=["description", "kind", "name", "memberof", "params", "returns", "deprecated"], dtype=object)

    return read(comment, declares)


def javascript(files: DataFrame) -> DataFrame:
    """(path, ordinal, description, kind, name, memberof, params, returns, deprecated) of every documentation comment."""
    found = corpus.documented(files)
    return found.select("path", "ordinal", _symbols(F.col("comment"), F.col("declares")).alias("s")).select("path", "ordinal", "s.*")


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, r"""^(['"])(.*)\1$""", "$2")


_WORD = r"""('[^']*'|"[^"]*"|[^\s'"]+)"""


def uci(files: DataFrame) -> DataFrame:
    """(path, section, type, name, ordinal, kind, key, value) of UCI files: an option or list entry a row, numbered in its section.

    A section is what follows a line ``config type ['name']``; of an option that is
    set again the last counts, entries of a list add up.  Lines before the first
    section, comments and lines that are neither are left out; a section without
    entries has none.
    """
    # A section's text is cut out as a whole, so its lines need no window to know it.
    sections = files.select("path", F.posexplode(F.slice(F.split(F.concat(F.lit("\n"), F.regexp_replace("content", "\r\n", "\n")), r"\n[ \t]*config[ \t]+"), 2, 1 << 30)).alias("section", "body"))
    head = F.split("body", "\n", 2)
    named = sections.select("path", "section", head[0].alias("head"), F.when(F.size(head) > 1, head[1]).otherwise("").alias("rest"))
    typed = named.select("path", "section", _bare(F.regexp_extract("head", rf"^{_WORD}", 1)).alias("type"), F.nullif(_bare(F.regexp_extract("head", rf"^{_WORD}[ \t]+{_WORD}", 2)), F.lit("")).alias("name"), F.split("rest", "\n").alias("lines")).where(F.col("type") != "")
    each = typed.select("path", "section", "type", "name", F.posexplode("lines").alias("ordinal", "line"))
    entry = rf"^[ \t]*(option|list)[ \t]+{_WORD}[ \t]+{_WORD}"
    rows = each.where(F.col("line").rlike(entry)).select("path", "section", "type", "name", "ordinal", F.regexp_extract("line", entry, 1).alias("kind"), _bare(F.regexp_extract("line", entry, 2)).alias("key"), _bare(F.regexp_extract("line", entry, 3)).alias("value"))
    options = rows.where("kind = 'option'").groupBy("path", "section", "type", "name", "kind", "key").agg(F.max_by("value", "ordinal").alias("value"), F.max("ordinal").alias("ordinal"))
    return rows.where("kind = 'list'").unionByName(options.select(*rows.columns))


def shell_functions(files: DataFrame) -> DataFrame:
    """(path, ordinal, name, arguments, description) of the functions of a shell library whose comment names them: lines ``# name(arguments)`` right above or inside a block of comment lines."""
    block = r"(?m)((?:^[ \t]*#[^\n!]*\n)+)[ \t]*([A-Za-z_]\w*)[ \t]*\(\)[ \t]*\{?"
    found = files.select("path", F.posexplode(F.regexp_extract_all("content", F.lit(block), F.lit(0))).alias("ordinal", "b"))
    comment = F.regexp_replace(F.regexp_extract("b", block, 1), r"(?m)^[ \t]*#[ \t]?", "")
    name = F.regexp_extract("b", block, 2)
    signature = F.concat(F.lit(r"(?m)^"), name, F.lit(r"[ \t]*[(]?([^)\n]*)[)]?[ \t]*$"))
    rows = found.select("path", "ordinal", name.alias("name"), comment.alias("comment"), signature.alias("signature"))
    return rows.select("path", "ordinal", "name", F.trim(F.expr("regexp_extract(comment, signature, 1)")).alias("arguments"), text.strip(F.expr("regexp_replace(comment, signature, '')")).alias("description"))


def hotplug(files: DataFrame) -> DataFrame:
    """(path, subsystem, order, name, variables, actions) of hotplug scripts: the folder behind ``hotplug.d`` is their subsystem, the digits in front of a name its order; the upper-case variables that a script reads, and the values of ACTION that it asks for."""
    place = r"(?:^|/)hotplug\.d/([^/]+)/(?:(\d+)-)?([^/]+)$"
    variables = F.array_sort(F.array_distinct(F.regexp_extract_all("code", F.lit(r"\$\{?([A-Z][A-Z0-9_]+)"), F.lit(1))))
    compared = F.regexp_extract_all("code", F.lit(r"""\$\{?ACTION\}?["']?[ \t]*(?:!?==?)[ \t]*["']?([a-z][\w-]*)"""), F.lit(1))
    cases = F.flatten(F.transform(F.regexp_extract_all("code", F.lit(r"""(?s)case[ \t]+["']?\$\{?ACTION\}?["']?[ \t]+in(.*?)esac"""), F.lit(1)), lambda b: F.flatten(F.transform(F.regexp_extract_all(b, F.lit(r"(?m)^[ \t]*\(?([a-z][\w|\- \t]*)\)"), F.lit(1)), lambda c: F.split(F.regexp_replace(c, r"[ \t]", ""), r"\|")))))
    code = F.regexp_replace("content", r"(?m)^[ \t]*#[^\n]*", "")
    rows = files.where(F.col("path").rlike(place)).select("path", F.regexp_extract("path", place, 1).alias("subsystem"), F.regexp_extract("path", place, 2).try_cast("int").alias("order"), F.regexp_extract("path", place, 3).alias("name"), code.alias("code"))
    return rows.select("path", "subsystem", "order", "name", variables.alias("variables"), F.array_sort(F.array_distinct(F.concat(compared, cases))).alias("actions"))
