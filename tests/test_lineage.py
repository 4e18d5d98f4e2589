"""End-to-end lineage on a four-task pipeline: datasets, propagation, change events."""

import pytest
from pyspark.sql import functions as F

from eventweave.operators import profile as pf
from eventweave.plans import lineage as ln
from eventweave.schemas import LITERALS
from helpers import events_frame

TOKS = "r r S T0 N0 T1 N1 T2 N2 T3 N3 E W4".split()


@pytest.fixture(scope="module")
def frames(spark):
    ev = events_frame(spark, {"p": TOKS})
    out = lambda i: f"s3://meta/p/n{TOKS.index(f'T{i}')}/outputs.pb"
    inp = f"s3://meta/p/n{TOKS.index('T0')}/inputs.pb"
    lits = spark.createDataFrame([
        (inp, "a", "schema", "mem://cases"),
        (out(0), "b", "schema", "mem://places"),
        (out(0), "z", "blob", None),
        (out(1), "c", "schema", "mem://joined"),
        (out(1), "d", "collection", None),
    ], LITERALS)
    cases = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    places = spark.range(10).select(F.col("id").alias("n"))
    joined = spark.createDataFrame([("x", "y", "z")] * 2, "A string, B string, C string")
    prof = pf.profile_many(spark, {"mem://cases": (cases, "mem://cases"),
                                   "mem://places": (places, "mem://places"),
                                   "mem://joined": (joined, "mem://joined")})
    return ln.build(spark, ev, lits, prof)


def test_profiles(frames):
    got = {r.dataset: (r.n_rows, r.n_cols, r.nbytes) for r in frames.profiles.collect()}
    # 10 x int64 = 80 bytes; id 16 + names 1 byte + 4 x 2 offsets + 1 validity byte
    assert got["mem://places"] == (10, 1, 80)
    assert got["mem://cases"] == (2, 2, 16 + 1 + 8 + 1)
    assert got["mem://joined"] == (2, 3, 3 * (2 + 8))


def test_inputs_propagate(frames):
    ins = sorted((r.task_index, r.dataset_name) for r in frames.inputs.collect())
    assert ins == [(0, "pkg.wf.t0.i0"), (1, "pkg.wf.t0.o0"), (2, "pkg.wf.t1.o0")]
    outs = sorted((r.task_index, r.dataset_name) for r in frames.outputs.collect())
    assert outs == [(0, "pkg.wf.t0.o0"), (1, "pkg.wf.t1.o0")]


def test_change_event_order(frames):
    rows = frames.mce.orderBy("grp", "slot", "item").collect()
    kinds = [r.entity_type for r in rows]
    assert kinds == ["dataset"] * 3 + ["dataFlow"] + ["dataJob"] * 4
    assert [len(r.aspects) for r in rows] == [4, 4, 4, 3, 3, 3, 3, 3]
    assert rows[3].urn == "urn:li:dataFlow:(flyte,dev.proj.pkg.wf,DEV)"


def test_task_snapshots(frames):
    t = {r.task_index: r for r in frames.task_entities.collect()}
    assert t[0].upstream_urns is None
    assert t[1].upstream_urns == ["urn:li:dataJob:(urn:li:dataFlow:(flyte,dev.proj.pkg.wf,DEV),pkg.wf.t0)"]
    assert t[3].input_urns == [] and t[3].output_urns == []
    assert [a.aspect for a in t[0].aspects] == ["dataJobInfo", "dataJobInputOutput", "ownership"]
    assert '"type":"COMMAND"' in t[0].aspects[0].json


def test_edges(frames):
    kinds = sorted(r.edge_type for r in frames.edges.collect())
    assert kinds.count("task_to_task") == 3
    assert kinds.count("dataset_to_task") == 3
    assert kinds.count("task_to_dataset") == 2


def test_dataset_metadata(frames):
    d = {r.dataset_name: r for r in frames.dataset_entities.collect()}
    props = d["pkg.wf.t0.o0"].aspects[0].json
    assert '"shape":"(10, 1)"' in props and '"nbytes":"80"' in props
    assert '"uri":"mem://places/00000"' in props


def test_type_class_in_the_change_event(frames):
    import json
    d = {r.dataset_name: r for r in frames.dataset_entities.collect()}
    md = json.loads(next(a.json for a in d["pkg.wf.t0.o0"].aspects if a.aspect == "schemaMetadata"))
    assert md["fields"] == [{"fieldPath": "n", "nativeDataType": "int64", "type": {"type": {"class": "Number"}},
                             "description": "n", "recursive": False, "nullable": False}]


def test_owners_tags_and_stamps_flow_through(spark, frames):
    import json
    from eventweave.operators import entities as en
    h = frames.header.selectExpr("*", "'about' as description", "map('k', 'v') as metadata", "'http://u' as url",
                                 "array('ann') as owners", "array('gold') as tags")
    flow = {a.aspect: json.loads(a.json) for a in en.flow_entities(h).first().aspects}
    assert flow["dataFlowInfo"]["description"] == "about" and flow["dataFlowInfo"]["customProperties"] == {"k": "v"}
    assert flow["ownership"]["owners"][0]["owner"] == "urn:li:corpuser:ann"
    assert flow["globalTags"]["tags"] == [{"tag": "urn:li:tag:gold"}]
    tasks = frames.tasks.selectExpr("*", "'step' as description", "array('bob') as owners", "array('t1') as tags")
    io = en.task_io(frames.inputs, frames.outputs)
    job = en.task_entities(en.task_links(tasks, frames.header, io)).first().aspects
    assert [a.aspect for a in job] == ["dataJobInfo", "dataJobInputOutput", "globalTags", "ownership"]
    assert json.loads(job[0].json)["description"] == "step"
    one = en.single_task(frames.task_entities, spark.createDataFrame([("proj-dev-p", "pkg.wf.t1")], "workflow_id string, task_name string"))
    assert [r.task_name for r in one.collect()] == ["pkg.wf.t1"]
