"""Patterns over a thread's joined bodies, and many patterns in one pass, against plain searches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import fixed, text
from siltstone.operators import threads

WORDS = ["you should", "should", "  ", "", "\t", "use it", "Use", " be", "have", "call", "shoulder", "x", "must be", "SNACK", "NACK", "nac", " ", "should\n", "\nuse", "proper", "y" * 1000]


def test_borders_compose_to_the_search_of_the_joined_text(spark):
    """Any number of bodies, blank ones between, of any length."""
    r = random.Random(7)
    rows = []
    for thread in range(400):
        for i in range(r.randint(1, 6)):
            rows.append((thread, i, "".join(r.choice(WORDS) for _ in range(r.choice([0, 1, 1, 2, 4]))) if r.random() > 0.05 else None))
    df = spark.createDataFrame(rows, "t int, i int, body string")
    for pattern in (fixed.CORRECTION, fixed.PROBLEM, r"a\s+b\s+c", r"should\s+use\s+it|be\s+have"):
        each = df.select("t", "i", text.matches(F.coalesce("body", F.lit("")), pattern).alias("one"), text.border(F.col("body"), pattern).alias("b"))
        got = {x["t"]: x["hit"] for x in each.groupBy("t").agg((F.bool_or("one") | text.crosses(F.transform(F.array_sort(F.collect_list(F.struct("i", "b"))), lambda x: x["b"]), pattern)).alias("hit")).collect()}
        joined = {}
        for t, _, body in rows:
            joined.setdefault(t, []).append(body or "")
        assert got == {t: re.search(pattern, "\n".join(b), re.IGNORECASE) is not None for t, b in joined.items()}


@pytest.mark.parametrize("parts", [["a", "b", "c"], ["a  b", "", "", " c"], ["xa\nb", "c"], ["a", "b c"], ["a", "b", "", "b", "c"], ["a", "x", "b", "c"], ["a", "bb", "c"]])
def test_three_segments(spark, parts):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "i int, body string")
    pattern = r"a\s+b\s+c"
    hit = df.select("i", text.matches(F.col("body"), pattern).alias("one"), text.border(F.col("body"), pattern).alias("b")).agg((F.bool_or("one") | text.crosses(F.transform(F.array_sort(F.collect_list(F.struct("i", "b"))), lambda x: x["b"]), pattern)).alias("hit")).first()["hit"]
    assert hit == (re.search(pattern, "\n".join(parts)) is not None)


def test_scores_over_several_messages(spark):
    """Three short messages make a correction; a letter in front of a NACK makes none."""
    row = lambda t, i, body: (f"{t}-{i}", i, t, "a@x", "s", body, None, "f", "", i, [], [], ["c"], tuple([False] * len(fixed.SIGNALS)))
    schema = "id string, ordinal int, root string, sender string, subject string, body string, date_iso string, source_file string, archive_url string, byte_offset long, files array<string>, commits array<string>, categories array<string>, signals struct<" + ",".join(f"{k}:boolean" for k in fixed.SIGNALS) + ">"
    rows = [row("long", 0, "you should" + " " * 1500), *[row("long", i, "") for i in range(1, 9)], row("long", 9, " " * 1500 + "use it"), row("snack", 0, "x" * 300 + "S"), row("snack", 1, "SNACK" + "y" * 199)]
    got = {r["thread_id"]: r["score_cents"] for r in threads.rollup(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"long": 40, "snack": 10}


def test_an_unknown_line_end_is_an_error():
    with pytest.raises(ValueError):
        text.segments(r"a[^x]b")
    assert text.segments("use .+ not|plain") == [] and text.segments(r"a\s+(?:b|c)") == [["a", "(?:b|c)"]]


def test_all_flags_equal_single_searches(spark):
    """Every pattern of the three lists, found by one pass or by itself; words inside words, overlaps, odd capitals, nulls."""
    r = random.Random(9)
    pieces = [w for kind in ("keywords", "categories", "signals") for w in text.flags_of(kind).words]
    pieces += ["should use", "do not", "NULL pointer", "remove the old patch", "static int void", "a.c:1:2: error:", "make[3]: ***", "FATAL: x not found", "use-after free", "Kernel", "ſegfault", "é", "\n", "LUCI", "rc.d/", "Initramfs", "uci "]
    texts = ["".join(r.choice(pieces) + r.choice(["", " ", "x", "\n"]) for _ in range(r.randint(0, 6))) for _ in range(1200)] + [None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", text.keywords(F.col("t")).alias("k"), text.categories(F.col("t")).alias("c"), text.signals(F.col("t")).alias("s")).collect()
    fold = lambda t: t.replace("K", "k")
    for g in got:
        t = texts[g["i"]]
        if t is None:
            continue
        has = lambda p, flags=re.IGNORECASE: re.search(p, fold(t), flags) is not None
        assert g["k"] == sorted(p for p in fixed.KEYWORDS if has(p)), t
        assert g["c"] == ([k for k, p in fixed.CATEGORIES.items() if has(p)] or ["uncategorized"]), t
        assert {k: g["s"][k] for k in fixed.SIGNALS} == {k: has(p, 0 if k == "has_code_block" else re.IGNORECASE) for k, p in fixed.SIGNALS.items()}, t


def test_words_that_decide():
    assert text.literal(r"init\.d") == "init.d" and text.literal("fail(?:ed|ure)?") == "fail" and text.literal("a+") is None and text.literal(r"\bx") is None
