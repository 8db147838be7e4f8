"""The pipeline against plain versions of its stages, each on its own input."""

import corpus_pipeline
import pytest
from test_near_copies import plain_groups
from test_text_operators import plain_spans

from siltstone.llm import pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = "file://" + str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, seen[-1], SF).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return [[r.asDict() for r in d.collect()] for d in seen], [d.columns for d in seen]


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "pii", "mix"]
    assert all(c == stages[1][0] for c in stages[1][:-1])


def test_each_stage(spark, stages):
    docs, lettered, distinct, clean, masked, mixed = stages[0]
    assert len(lettered) >= 0.99 * sum(any(c.isalpha() for c in d["text"] or "") for d in docs)
    # the stage's contract: five-word shingles and a similarity of 0.8 (that of op3's query binds the query alone)
    groups = plain_groups({d["doc_id"]: d["text"] for d in lettered})
    assert sorted(d["doc_id"] for d in distinct) == sorted(set(groups.values())) and len(set(groups.values())) < len(groups)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    has = {d["doc_id"] for d in distinct if any(t in d["text"] for t in items)}
    assert has and {d["doc_id"] for d in clean} == {d["doc_id"] for d in distinct} - has
    before = {d["doc_id"]: d for d in clean}
    assert len(masked) == len(clean)
    for d in masked:
        old = before[d["doc_id"]]["text"]
        found = plain_spans(old)
        assert (d["text"] == old) == (not any(found.values()) and not pii.secrets(old))
        assert not any(plain_spans(d["text"])[k] for k in ("email", "phone"))
    left = {d["doc_id"]: d for d in masked}
    assert 0 < len(mixed) < len(masked) and all(d == left[d["doc_id"]] for d in mixed)


def test_run_is_all_stages(spark, stages):
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(d["doc_id"] for d in stages[0][-1])


def test_stages_take_odd_documents(spark, odd, nothing):
    base = ["doc_id", "text", "lang", "source", "n_chars"]
    clash = odd.select(*base).toDF(*base).selectExpr(*base, "1 as `meta.x`", "'t' as `Text`", "2 as `Doc_ID`")
    for docs in (odd, odd.select(*base), nothing.select(*base), clash, clash.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.collect()
