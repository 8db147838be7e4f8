import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, fp long, key string, topic string, probability double, block_id long, _key string, c0 string, place double"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names the operators use too."""
    base = prose(1, 120)
    texts = [base, base, base + " " + prose(2, 80), prose(3, 60) + "\n" + base[:400], "", None, "word", " \t\n ", "Ünï cödé ßtraße " * 30, prose(4, 30_000), "12345 !!! ???", "mail a.b@c.example and +1 (555) 123-4567", prose(5, 55), prose(5, 55) + " end"]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[2], (None, base, "en", "src0", 5), (None, None, None, None, None)]
    return [(*r, 7, 8, "k", "t", 0.5, 9, "k2", "c", 0.1) for r in rows]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def bench(spark):
    words = prose(1, 120).split()
    items = [(0, " ".join(words[10:40])), (1, None), (2, ""), (3, "too short"), (4, prose(9, 40)), (None, prose(10, 20))]
    return spark.createDataFrame(items, "item_id long, text string")
