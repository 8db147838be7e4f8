"""Every query that has a statement gives the same rows in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from siltstone.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(frame, columns):
    plain = lambda v: None if v is None or v != v else list(v) if hasattr(v, "__len__") and not isinstance(v, str) else v
    return sorted(repr(tuple(plain(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_statement(spark, con, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), con.execute(catalogue.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_queries_without_a_statement(spark):
    """A vocabulary of byte pairs; tests/test_tokens.py compares it with another encoder."""
    assert set(catalogue.QUERIES) - set(catalogue.SQL) == {"bpe_tokens"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
