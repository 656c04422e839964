"""The registered queries and the pipeline on the smallest tables."""

import os

import pytest
from oracle import compare, connect

import corpus_pipeline
from rivulet.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query_over_all_documents(spark, sf_dir):
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    rows = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).count()
    for n in ("op1_quality_rules", "op2_personal_data", "op5_sharding", "op6_simhash", "op9_token_counts", "op12_toxicity"):
        assert QUERIES[n](spark, sf_dir).count() == rows


def test_personal_data_counts_follow_the_spans(spark, tmp_path):
    texts = ["a@b.c d@e.f 1.2.3.4", "none", None, "+12345678, 4111111111111111, 4111 1111 1111 1111 g@h.i"]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op2_personal_data"](spark, str(tmp_path)).collect()
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found}
    assert got == {0: (2, 1, 0, 0), 1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 2, 1)}


def test_terms_disclose_from_anywhere_in_the_text(spark, tmp_path):
    common = [(i, f"the plain text number n{i} of the lot") for i in range(40)]
    telling = [(100 + i, "zorblax " + "of the lot " * 9 + f"number n{i} by a@b.example.com") for i in range(5)]
    docs = spark.createDataFrame([(d, t, len(t)) for d, t in common + telling], "doc_id long, text string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spans = {r.doc_id: r.spans for r in QUERIES["op2_personal_data"](spark, str(tmp_path)).collect()}
    masked = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    for i, t in telling:
        assert "removed:0:7" in spans[i].split(",") and "zorblax" not in masked[i] and "[EMAIL]" in masked[i]
    assert all(spans[i] == "" and masked[i] == t for i, t in common)


def test_pipeline_stages_keep_columns_and_decide(spark, sf_dir):
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    columns, kept = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.written(stage(spark, docs, sf_dir), "stage")
        now = {r.doc_id for r in result.select("doc_id").collect()}
        assert now <= kept and len(now) == result.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == columns
        if name.startswith(("PII", "Sentence")):
            assert now == kept
        docs, kept = result, now
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
