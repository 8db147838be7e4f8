"""Raking with the sources in Spark gives what raking in the driver gives."""

import random

import pytest

from siltstone.llm import mixing


def rows(spark, n=4000):
    r = random.Random(8)
    some = [(i, r.choice([None, *(f"s{int(r.paretovariate(0.7))}" for _ in range(3))]), r.choice(["en", "fr", None]), r.choice(["t0", "t1", "none"]), r.choice([0, 1, 5, 40])) for i in range(n)]
    return spark.createDataFrame(some, "doc_id long, source string, lang string, topic string, n_tokens long")


def cells(df):
    return {tuple(r)[:3]: (r["words"], r["weight"], r["probability"], r["gap"]) for r in df.collect()}


TARGETS = [{"s1": 0.5, "s2": 0.2, "s3": 0.2, "never": 0.1, None: 0.1}, {"en": 0.7, "fr": 0.3}, {"t0": 1.0, "t1": 1.0, "none": 2.0}]


@pytest.mark.parametrize(("share", "targets"), [(0.5, None), (0.05, None), (1.0, None), (0.3, TARGETS)])
def test_both_ways_agree(spark, share, targets):
    df = rows(spark)
    want, got = cells(mixing.probabilities(df, share, targets)), cells(mixing.probabilities(df, share, targets, most=10))
    assert want.keys() == got.keys() and len(want) > 100
    for k, w in want.items():
        assert got[k] == pytest.approx(w, rel=1e-6, abs=1e-8), k


def test_no_words(spark):
    df = spark.createDataFrame([(i, f"s{i}", "en", "none", 0) for i in range(20)], "doc_id long, source string, lang string, topic string, n_tokens long")
    assert {v[1:] for v in cells(mixing.probabilities(df, 0.5, most=5)).values()} == {(0.0, 1.0, 0.0)}


def test_topics_are_fitted_on_all_texts(spark):
    """Words of one text in three thousand weigh by their rarity among all of them, and rows may lie in any partitions."""
    import math

    import pyarrow as pa

    rows = [(i, f"common{i % 7} common{i % 5} ordinary{i % 11} w{i:05}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, again = mixing.topic_model(docs.repartition(2)), mixing.topic_model(docs.repartition(9))
    assert (model.table == again.table).all() and model.offsets.keys() == {"en"}
    held = {}
    for _, text, _ in rows:
        for b in set(mixing.word_buckets(pa.array([text], type=pa.large_string()))[0].tolist()):
            held[b] = held.get(b, 0) + 1
    seen = {b for b in range(model.table.shape[0]) if (model.table[b] != 0).any()}
    assert seen == {b for b, n in held.items() if math.log((1 + len(rows)) / (1 + n)) > 0}
