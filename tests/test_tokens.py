"""Merges by rank against another encoder, and sums over texts."""

import random

import pytest
import tiktoken

from siltstone.functions import tokens

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("other", pat_str=tokens.CUT, mergeable_ranks=tokens.ranks(PATH), special_tokens={})


def test_merges(encoder):
    r, known = random.Random(3), tokens.ranks(PATH)
    alphabet = ["a", "the", "tion", "é", "中", "\U0001f600", " ", "x", "zz", "ing", "0", "_"]
    for _ in range(2000):
        piece = "".join(r.choice(alphabet) for _ in range(r.randint(1, 40)))
        assert tokens.merged(piece.encode(), known) == encoder._encode_single_piece(piece)
    for long in ("a" * 20_001, "ab" * 7000, " " * 5000):
        assert tokens.merged(long.encode(), known) == encoder._encode_single_piece(long)
    assert tokens.merged(b"", known) == []


def test_counts_and_totals(spark, encoder):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(-1, "odd", None), (-2, "odd", ""), (-3, "odd", "it's  \n\n x  y 12 don'T  ")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    want = {i: len(encoder.encode_ordinary(t or "")) for i, _, t in rows}
    assert {r["doc_id"]: r["tokens"] for r in tokens.counts(df, "doc_id", PATH).collect()} == want
    by = {}
    for i, s, _ in rows:
        by[s] = by.get(s, 0) + want[i]
    assert {r["source"]: r["tokens"] for r in tokens.totals(df, "source", PATH).collect()} == by
