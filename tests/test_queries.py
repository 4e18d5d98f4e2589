"""Driver contract and stream = batch equality on the smallest driver tables."""

from helpers import SF001


def test_entry_flagship(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert len(rows) == 45
    assert len({r.workflow_id for r in rows}) == 23


def test_every_oracle_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_equals_batch_epochs(spark):
    from eventweave.plans import queries as Q
    batch = sorted(tuple(r) for r in Q.prefix_epochs(spark, SF001).collect())
    stream = sorted(tuple(r) for r in Q.stream_epochs(spark, SF001).collect())
    assert batch == stream
    assert len(batch) == 423


def test_catalog_names(spark):
    from pyspark.sql import functions as F
    from eventweave.sinks import catalog as cat
    inst = spark.createDataFrame([("w", 0, 0, "foo", "mem://x", 1)],
                                 "workflow_id string, slot long, ordinal long, dataset_name string, "
                                 "schema_uri string, created_ns long")
    head = spark.createDataFrame([("w", "a.b.c")], "workflow_id string, pipeline_name string")
    r = cat.catalog_names(inst, head, "bucket/prefix").first()
    assert (r.db, r.table_name) == ("flyte_a_b", "foo")
    assert r.path.startswith("bucket/prefix/flyte_a_b/foo/")
    r = cat.catalog_names(inst, head, "bucket/prefix", db_name="mydb").first()
    assert r.path.startswith("bucket/prefix/mydb/foo")
    dotted = inst.withColumn("dataset_name", F.lit("p.q.o0"))
    r = cat.catalog_names(dotted, head, "b").first()
    assert r.table_name == "p_q_o0" and r.path == "b/flyte_a_b/p.q.o0/"
