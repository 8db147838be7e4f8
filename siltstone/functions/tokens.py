"""Byte-pair tokens: texts are cut by Spark, each distinct piece is merged once by rank, and counts are summed.

A vocabulary is a rank file (base64 token and rank a line), read from a path that
every executor has.  Of a corpus the pieces are counted first, so a piece that
a third of all texts hold is one row a task and then one row.
"""

from __future__ import annotations

import base64
import functools
import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Fixed value: how a text is cut before pairs are merged, for byte-pair vocabularies with these rank files.
CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks; kept for the process."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merged(piece: bytes, known: dict[bytes, int]) -> list[int]:
    """The tokens of a piece: of all neighbours that make a token the pair of lowest rank is joined, the leftmost first, until none is left.

    The parts are a linked list and the pairs a heap, so a long piece takes
    n log n steps.  A pair that has changed since it was put in the heap is known by
    its end.
    """
    if piece in known:
        return [known[piece]]
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := known.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if end[i] < 0 or j >= n or end[j] != stop:
            continue
        end[i], end[j], after[i] = stop, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := known.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if before[i] >= 0 and (r := known.get(piece[before[i] : stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(known[piece[i : end[i]]])
        i = after[i]
    return out


def pieces(text: Column) -> Column:
    """The pieces of a text, between which no pair is merged; a null text has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit("(?U)" + CUT), F.lit(0)), F.array().cast("array<string>"))


def piece_tokens(path: str):
    """A column function: the tokens of a piece."""

    @pandas_udf(T.ArrayType(T.IntegerType()))
    def tokens(found: pd.Series) -> pd.Series:
        known = ranks(path)
        return pd.Series([merged(p.encode(), known) for p in found], dtype=object)

    return tokens


def totals(texts: DataFrame, by: str, path: str, text: str = "text") -> DataFrame:
    """(by, tokens): tokens of all texts of a group."""
    each = texts.select(by, F.explode_outer(pieces(F.col(text))).alias("piece")).groupBy(by, "piece").agg(F.count("*").alias("n"))
    found = each.select(by, "n", F.when(F.col("piece").isNull(), 0).otherwise(F.size(piece_tokens(path)(F.coalesce("piece", F.lit(""))))).cast("long").alias("tokens"))
    return found.groupBy(by).agg(F.sum(F.col("n") * F.col("tokens")).alias("tokens"))


def counts(texts: DataFrame, key: str, path: str, text: str = "text") -> DataFrame:
    """(key, tokens) of every row, with a key of its own: pieces are counted by row, merged once each, and joined again."""
    each = texts.select(key, F.explode_outer(pieces(F.col(text))).alias("piece")).groupBy(key, "piece").agg(F.count("*").alias("n"))
    once = each.select("piece").where("piece is not null").distinct()
    sized = once.select("piece", F.size(piece_tokens(path)("piece")).cast("long").alias("tokens"))
    return each.join(sized, "piece", "left").groupBy(key).agg(F.coalesce(F.sum(F.col("n") * F.col("tokens")), F.lit(0)).alias("tokens"))
