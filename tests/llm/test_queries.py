import duckdb
import pytest

from siltstone.llm import queries

SF = "/root/testdata/sf0.001"


def test_there_is_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_statement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF), con.execute(queries.oracle_sql()[name])
    columns = sorted(got.columns)
    names = [d[0] for d in want.description]
    assert columns == sorted(names)
    rows = [tuple(r[names.index(c)] for c in columns) for r in want.fetchall()]
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, rows)) and rows


#: The columns that a contract names for a query; more may follow.
CONTRACT = {
    "op2": "doc_id n_words n_removed kept_sha256", "op3": "doc_id fingerprint component_id", "op5": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op6": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op7": "page_id host path rule verdict", "op8": "doc_id n_bytes n_removed n_spans kept_sha256", "op10": "doc_id held_out lang_pred score",
    "op11": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", "op12": "vec_id cluster distance cluster_inertia inertia centroid_sha256", "op13": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_has_the_rows_of_its_table(spark, name):
    got = queries.queries()[name](spark, SF)
    assert set(CONTRACT.get(name.split("_")[0], "doc_id").split()) <= set(got.columns)
    rows = got.count()
    if name.startswith("op13"):
        assert rows == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count() + 1
    elif not name.startswith("op1_"):
        table = "embeddings" if name.startswith("op12") else "pages" if name.startswith("op7") else "documents"
        assert rows == spark.read.parquet(f"{SF}/{table}.parquet").count()
    else:
        assert rows > 0
