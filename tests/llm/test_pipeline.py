"""The pipeline's stages, each on what its predecessor kept."""

import duckdb
from test_operators import brute_groups, check_pieces, texts_of  # noqa: F401

import corpus_pipeline
from eventweave.llm import pii


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    clean = {r.doc_id for r in held["toxicity"].collect()}
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    spared = [i in clean for i, y in toxic.items() if not y]
    assert sum(spared) >= 0.97 * len(spared)
    groups = brute_groups([(i, before[i].text) for i in clean])
    assert {r.doc_id for r in held["ngram_join"].collect()} == {i for i, _, c in groups if i == c}
    final = held["personal_data"].collect()
    assert {r.doc_id for r in final} == {r.doc_id for r in held["decontamination"].collect()}
    for r in final:
        assert r.text == pii.redact([before[r.doc_id].text])[0]
        assert r.n_chars == (before[r.doc_id].n_chars if r.text == before[r.doc_id].text else len(r.text))
    check_pieces([(r.doc_id, r.text) for r in final], held["packing"].collect())


def test_odd_rows(spark, odd_docs, sf):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() > 0
    empty = odd_docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
