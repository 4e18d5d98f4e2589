"""Maps and frames that nobody reads are neither sorted nor landed."""

from pyspark.sql import functions as F

from eventweave.operators import datasets as ds
from eventweave.plans import lineage as ln
from eventweave.plans import queries as Q
from eventweave.schemas import LITERALS
from eventweave.session import land
from helpers import SF001


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_maps_of_the_chain_are_numbered(spark):
    chain = spark.createDataFrame(
        [("w", 0, "in", "out"), ("w", 1, "in1", None), ("v", 0, None, "other")],
        "workflow_id string, task_index long, input_uri string, output_uri string")
    lits = spark.createDataFrame(
        [("in", "a", "schema", "s1"), ("out", "b", "schema", "s2"), ("out", "d", "blob", None), ("in1", "c", "schema", "s3"),
         ("", "e", "schema", "s4"), ("far", "f", "schema", "s5"), (None, "g", "schema", "s6")], LITERALS)
    kept = ds.chain_literals(lits, chain)
    assert kept.columns == lits.columns
    assert sorted(r["var"] for r in kept.collect()) == ["a", "b", "d", "e"]
    assert "LeftSemi" in plan(Q.dataset_names(spark, SF001))


def test_landed_rows_have_a_size_and_only_the_columns_asked_for(spark):
    df = land(spark.range(1000).select("id", F.lit("x").alias("text")))
    assert df.count() == 1000
    assert "ReadSchema: struct<id:bigint>" in df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100_000


def test_flows_do_not_land_datasets(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ln, "land", lambda df: seen.append(df.columns) or land(df))
    rows = Q.flow_aspects(spark, SF001).collect()
    assert rows and not [names for names in seen if "dataset_name" in names]
