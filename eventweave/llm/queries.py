"""One query per operator over the whole of its table; digests are derived from the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import (
    collocations,
    decontaminate,
    filter_audit,
    fingerprint,
    language,
    ngram_join,
    packing,
    page_text,
    pii,
    quality,
    repeats,
    secret_scan,
    toxicity,
)
from eventweave.llm.oracle import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fold(parts: int):
    """crc32 of the doc_id's text, modulo the number of folds."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "p_good", "kept")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(_table(spark, sf_dir, "documents"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(_table(spark, sf_dir, "pages"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.select("doc_id", "text", "lang").where(_fold(4) != 2))
    return language.identify(docs, model).select(
        "doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled_part(docs, _table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", _table(spark, sf_dir, "labels"))


def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_ngram_join, op3_packing, op4_page_text, op5_repeats, op6_decontamination, op7_secrets,
    op8_language, op9_toxicity, op10_pii, op11_collocations, op12_filter_audit,
    op13_fingerprint)}

__all__ = ["QUERIES", "SQL"]
