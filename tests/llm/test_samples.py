"""Training samples: rare classes are drawn, equal rows once, whatever the joins."""

import pytest
from pyspark.sql import functions as F

from eventweave.llm import language, toxicity

TOXIC = ["you idiot fool number {k}", "what an idiot {k} you are"]
CALM = ["nice calm words number {k}", "more calm text {k} here"]


def labelled(spark, toxic, calm):
    rows = [(k, TOXIC[k % 2].format(k=k), 1) for k in range(toxic)]
    rows += [(10_000 + k, CALM[k % 2].format(k=k), 0) for k in range(calm)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_rare_positives_are_learned(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    monkeypatch.setattr(toxicity, "CLASS_ROWS", 20)
    model = toxicity.train(labelled(spark, 20, 3000))
    docs = spark.createDataFrame([(1, "you idiot fool"), (2, "nice calm words")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert score[1] > score[2]


def test_labels_that_cannot_be_drawn_are_an_error(spark):
    long = labelled(spark, 0, 30).union(spark.createDataFrame([(5, "idiot " * 9000, 1)], "a long, b string, c int"))
    with pytest.raises(ValueError):
        toxicity.train(long)
    assert toxicity.train(labelled(spark, 0, 30)) is None
    assert toxicity.train(labelled(spark, 0, 0)) is None


def test_labelled_part_joins_without_texts(spark):
    docs = labelled(spark, 40, 40).drop("toxic").selectExpr("*", "1 as y", "'x' as place")
    marks = spark.createDataFrame([(k, v) for k in range(40) for v in (0, 1)] + [(None, 1), (10_003, None)],
                                  "doc_id long, toxic int")
    part = toxicity.labelled_part(docs, marks)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    assert part.where(held).count() == 0 and part.where("toxic <> 1").count() == 0
    assert part.count() == part.select("doc_id").distinct().count()


def test_rare_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    rows = [(k, f"the cat and the dog {k} walked along the road to the house", "en") for k in range(2000)]
    rows += [(9000 + k, f"кошка и собака {k} шли по дороге к дому", "ru") for k in range(12)] + [(1, None, "en"), (None, "x", "en")]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, lang string")
    model = language.train(df)
    assert model[0] == ["en", "ru"]
    docs = spark.createDataFrame([(1, "собака шла к дому"), (2, "the dog on the road")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()} == {1: "ru", 2: "en"}
