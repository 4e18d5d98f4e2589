"""Null doc_ids and doc_ids of several texts in the filtering stages."""

import corpus_pipeline
from eventweave.llm import decontaminate, tables, toxicity
from pyspark.sql import functions as F
from test_operators import ITEM

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_copies(spark, sf):
    base = " ".join(f"w{k}" for k in range(80))
    rows = [(1, base), (None, base), (None, base + " more"), (2, "one text of the second document here"), (2, base + " end"),
            (None, "a text with no number that stands alone"), (None, "a text with no number that stands alone"), (None, None)]
    got = texts(corpus_pipeline.one_of_each_group(spark, frame(spark, rows), sf))
    alone = sorted([(None, "a text with no number that stands alone"), (None, None)], key=str)
    assert [g for g in got if g[0] is None] == alone
    assert (2, "one text of the second document here") in got and sum(base in (t or "") for _, t in got) == 1


def test_equal_rows_are_one_document(spark, sf):
    base = " ".join(f"w{k}" for k in range(80))
    rows = [(1, base)] * 3 + [(2, "short text of its own")] * 2 + [(3, "")] * 2 + [(None, "no number")] * 2
    df = frame(spark, rows).selectExpr("*", "1 as least", "2 as row_key", "3 as most")
    assert texts(corpus_pipeline.one_of_each_group(spark, df, sf)) == sorted(
        [(1, base), (2, "short text of its own"), (3, ""), (None, "no number")], key=str)


def test_large_key_tables_are_shuffled(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_KEYS", 0)
    test_near_copies(spark, sf)
    test_equal_rows_are_one_document(spark, sf)
    test_leaks(spark)


def test_leaks(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, ITEM), (None, "nothing"), (3, ITEM), (3, "another text"), (None, None)]
    out = decontaminate.clean(frame(spark, rows).withColumn("row_key", F.lit("mine")), bench)
    assert {r.row_key for r in out.collect()} == {"mine"}
    assert texts(out) == sorted(
        [(None, "nothing"), (3, "another text"), (None, None)], key=str)


def test_toxic(spark, sf, monkeypatch):
    model = toxicity.fit(["you idiot fool", "nice calm words", "an idiot again", "more calm text here"] * 30, [1, 0, 1, 0] * 30)
    monkeypatch.setattr(toxicity, "train", lambda *a: model)
    rows = [(None, "you idiot fool"), (None, "nice calm words"), (3, "you idiot fool"), (3, "more calm text here"), (None, None)]
    assert texts(corpus_pipeline.drop_toxic(spark, frame(spark, rows), sf)) == sorted(
        [(None, "nice calm words"), (3, "more calm text here"), (None, None)], key=str)
