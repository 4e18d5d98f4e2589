"""Metadata merge (C6) and expiry of runs that never complete (T4)."""

import uuid

from pyspark.sql import functions as F

from eventweave.operators.profile import merge_metadata
from eventweave.session import checkpoint_dir
from eventweave.sources import envelope as envl
from eventweave.streaming import gate_stream as gs
from helpers import events_frame


def test_merge_metadata_overwrites_shape(spark):
    df = spark.createDataFrame([({"uri": "u", "shape": "old", "k": "v"},)], "m map<string,string>")
    r = df.select(merge_metadata(F.col("m"), F.lit(4), F.lit(7), F.lit(80)).alias("x")).first().x
    assert r == {"uri": "u", "k": "v", "shape": "(4, 7)", "nbytes": "80"}


def test_incomplete_run_expires(spark):
    root = f"{checkpoint_dir(spark)}/t4-{uuid.uuid4().hex}"
    x = events_frame(spark, {"x": "r r S T0".split()})
    y = events_frame(spark, {"y": "r r S T0 N0 E r W4".split()})
    envl.encode(x).repartition(1).write.parquet(f"{root}/b0000")
    envl.encode(y).repartition(1).write.parquet(f"{root}/b0001")
    cuts, _ = gs.replay_stream(spark, root, expire_after_ms=1)
    got = {(r.workflow_id, r.status, r.n_emitted) for r in cuts.collect()}
    assert ("proj-dev-y", "complete", 8) in got
    assert ("proj-dev-x", "expired", 4) in got
