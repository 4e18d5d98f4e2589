"""Cases that once went wrong: odd events, targets, catalog names, history, nested bytes, restarts."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from eventweave.operators import gate as gt
from eventweave.operators import profile as pf
from eventweave.operators import replay as rp
from eventweave.options import DEFAULT
from eventweave.plans import lineage as ln
from eventweave.plans import queries as Q
from eventweave.session import checkpoint_dir
from eventweave.sinks import catalog as cat
from eventweave.sinks import targets as tg
from eventweave.sources import envelope as envl
from eventweave.streaming import gate_stream as gs
from helpers import events_frame


def stream_cuts(spark, events, files=2):
    root = f"{checkpoint_dir(spark)}/fix-{uuid.uuid4().hex}"
    gs.land_envelopes(envl.encode(events), root, files)
    return gs.replay_stream(spark, root, files_per_trigger=1)


def test_null_phase_counts_as_an_event(spark):
    ev = events_frame(spark, {"p": "r r S T0 N0 E r r W4".split()})
    ev = ev.withColumn("phase", F.when(F.col("arrival_seq") == 2, None).otherwise(F.col("phase")))
    cut = rp.prefix_cut(ev)[1].first()
    assert cut.n_emitted == 9 and cut.accepted
    assert gt.gate(ev).first().n_events == 9


def test_all_epochs_in_batch_and_stream(spark):
    ev = events_frame(spark, {"p": "r r r r S T0 N0 W4".split() * 4})
    batch = {(r.epoch, r.cut_seq, r.n_emitted) for r in rp.prefix_epochs(ev.coalesce(2)).collect()}
    assert len(batch) == 4
    cuts, _ = stream_cuts(spark, ev)
    assert {(r.epoch, r.cut_seq, r.n_emitted) for r in cuts.collect()} == batch


def test_run_key_keeps_empty_parts_and_time_defaults(spark):
    body = """{"Subject": "%s", "Message": "%s"}"""
    import base64
    import json
    msg = {"event": {"executionId": {"name": "x", "domain": "d"}, "phase": 4, "outputUri": "u", "occurredAt": {"nanos": 7}}}
    text = body % (envl.SUBJECTS["workflow"], base64.b64encode(json.dumps(msg).encode()).decode())
    good, _ = envl.decode(spark.createDataFrame([(text, 1)], "body string, arrival_seq long"))
    r = good.first()
    assert r.workflow_id == "-d-x" and r.occurred_at_ns == 7


def test_emit_off_writes_nothing(spark):
    frames = Q._lineage(spark, SF001, replace(DEFAULT, emit=False))

    class Never:
        name = "never"

        def write(self, frames, batch=None):
            raise AssertionError("called")

    assert tg.fanout(spark, frames, [Never()]).count() == 0
    assert tg.fanout(spark, Q._lineage(spark, SF001, DEFAULT), []).count() == 0


def test_one_bad_pipeline_name_fails_alone(spark):
    root = f"{checkpoint_dir(spark)}/names-{uuid.uuid4().hex}"
    inst = spark.createDataFrame([("a", 0, 0, "x.o0", "mem://t", 1), ("b", 0, 0, "y.o0", "mem://t", 1)],
                                 "workflow_id string, slot int, ordinal int, dataset_name string, schema_uri string, created_ns long")
    head = spark.createDataFrame([("a", "solo"), ("b", "dev.proj.wf")], "workflow_id string, pipeline_name string")
    names = cat.catalog_names(inst, head, root)
    log = cat.write_catalog(spark, cat.latest_writes(names), lambda uri: spark.range(3))
    got = {r.table_name: (r.status, r.db) for r in log.collect()}
    assert got["x_o0"][0] == "failed" and got["y_o0"] == ("written", "flyte_dev_proj")
    spark.sql("DROP DATABASE flyte_dev_proj CASCADE")


def test_history_continues_over_batches(spark):
    def hist(*fields):
        return spark.createDataFrame([("d", "t", k + 1, k, f) for k, f in enumerate(fields)],
                                     "db string, table_name string, version long, since_ns long, fields_text string")
    first = hist("a", "b")
    assert cat.continue_history(hist("b"), first).count() == 0
    more = cat.continue_history(hist("b", "c", "a"), first)
    assert sorted((r.version, r.fields_text) for r in more.collect()) == [(3, "c"), (4, "a")]
    assert [r.version for r in cat.continue_history(hist("z"), first).collect()] == [3]


def test_nested_bytes(spark):
    df = spark.range(100).select(
        F.struct(F.col("id").alias("a"), F.lit("text").alias("b")).alias("s"),
        F.create_map(F.lit("key"), F.col("id")).alias("m"),
        F.array(F.array(F.col("id"), F.col("id")), F.array(F.col("id"))).alias("ll")).coalesce(1)
    got = pf.profile(df, "nested").first().nbytes
    want = df.toArrow().nbytes
    assert abs(got - want) <= 0.02 * want


def test_metadata_batch_replaces_itself(spark):
    root = f"{checkpoint_dir(spark)}/mce-{uuid.uuid4().hex}"
    ev = events_frame(spark, {"p": "r r S T0 N0 E r W4".split()})
    lits = spark.createDataFrame([], "uri string, var string, kind string, schema_uri string")
    prof = pf.profile_many(spark, {"mem://t": (spark.range(3), "mem://t")})
    target = tg.MetadataTarget(f"{root}/mce")
    frames = ln.build(spark, ev, lits, prof)
    for _ in range(2):
        assert tg.fanout(spark, frames, [target], "00000001").count() == 2
    assert spark.read.parquet(f"{root}/mce").count() == 2


def test_stream_restart_adds_nothing(spark):
    """A stopped and restarted stream goes on from its checkpoint."""
    root = f"{checkpoint_dir(spark)}/restart-{uuid.uuid4().hex}"
    ev = events_frame(spark, {"p": "r r S T0 N0 E r W4".split(), "q": "r r S T0 N0 E r W4".split()})
    gs.land_envelopes(envl.encode(ev), f"{root}/landing", 2)
    for _ in range(2):
        gate = gs.run_stream(spark, f"{root}/landing", f"{root}/gate")
    got = sorted((r.workflow_id, r.n_emitted) for r in gate.cuts().collect())
    assert got == [("proj-dev-p", 8), ("proj-dev-q", 8)]


def test_checkpoint_dir_is_required_on_a_cluster():
    class Option:
        def isDefined(self):
            return False

        def isEmpty(self):
            return True

    class Jsc:
        def sc(self):
            return type("S", (), {"getCheckpointDir": lambda s: Option()})()

    class Context:
        master, _jsc = "spark://host:7077", Jsc()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda s, k, d=None: d})()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
