"""Unseen identifiers beside seeds, beside conflicting ones, and over two hops."""

from siltstone.llm import pii

SEEDS = [f"+1 555 123 45{i}" for i in range(10, 20)]


def added(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r["doc_id"] for r in pii.detect(rows).collect() if r["n_added"])


def test_several_unseen_numbers_under_one_pattern(spark):
    seeds = [f"text {i} please call me at {p} now" for i, p in enumerate(SEEDS)]
    for n_seeds, n_new in ((5, 2), (10, 3), (3, 60)):
        unseen = [f"also call me at 55519{i:05d} now" for i in range(n_new)]
        assert added(spark, seeds[:n_seeds] + unseen) == list(range(n_seeds, n_seeds + n_new))


def test_conflicting_instances_make_a_pattern_unreliable(spark):
    seeds = [f"text {i} the order number {p} is here" for i, p in enumerate(SEEDS[:4])]
    unseen = [f"the order number 55519{i:05d} is here" for i in range(3)]
    for other in ("1234.5678.{}x", "12345678901{:02d}7"):
        assert added(spark, seeds + unseen + ["the order number " + other.format(i + 10) + " is here" for i in range(9)]) == []
    assert added(spark, seeds + unseen) == [4, 5, 6]


def test_accepted_instances_induce_the_next_pattern(spark):
    seeds = [f"please call me at {p} now" for p in SEEDS[:4]]
    met = [f"call me at 55519{i:05d} or dial the line 55519{i:05d} now" for i in range(3)]
    last = ["dial the line 5552000001 now", "dial the line 5552000002 now"]
    assert added(spark, seeds + met + last) == [4, 5, 6, 7, 8]


def test_two_accepted_instances_are_no_support(spark):
    seeds = [f"please call me at {p} now" for p in SEEDS[:4]]
    met = [f"call me at 55519{i:05d} or dial the line 55519{i:05d} now" for i in range(2)]
    assert added(spark, [*seeds, *met, "dial the line 5552000001 now"]) == [4, 5]
