"""Work that must not repeat or grow beside the rows: columns, scans, verdicts, landed names."""

import uuid

from pyspark.sql import functions as F

from eventweave.operators import datasets as ds
from eventweave.operators import gate as gt
from eventweave.operators import replay as rp
from eventweave.schemas import EXEC_EVENTS, LITERALS
from eventweave.session import checkpoint_dir
from eventweave.sinks import catalog as cat
from eventweave.sources import adapter
from helpers import SF001, events_frame


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def landed(spark, df):
    path = f"{checkpoint_dir(spark)}/growth-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_unread_event_and_literal_columns_are_not_worked_out(spark):
    ev = adapter.exec_events(spark, SF001)
    assert [(f.name, f.dataType) for f in ev.schema] == [(f.name, f.dataType) for f in EXEC_EVENTS]
    narrow = plan(ev.select("workflow_id", "arrival_seq"))
    assert "inputs.pb" not in narrow and ".etl.part" not in narrow
    lits = adapter.literals(spark, SF001)
    assert [(f.name, f.dataType) for f in lits.schema] == [(f.name, f.dataType) for f in LITERALS]
    assert "dataset://" not in plan(lits.select("uri", "kind"))


def test_a_task_with_both_directions_comes_from_one_scan_of_the_chain(spark):
    chain = landed(spark, spark.createDataFrame(
        [("w", 0, "p.t0", "1", 5, 2, "in", "out"), ("w", 1, "p.t1", "1", 6, 2, "in1", None), ("v", 0, "p.t", "x", 7, 1, None, "out")],
        "workflow_id string, task_index long, task_name string, task_version string, occurred_at_ns long, n_task_ok long, "
        "input_uri string, output_uri string"))
    lits = spark.createDataFrame([("in", "a", "schema", "s1"), ("out", "b", "schema", "s2"), ("in1", "c", "schema", "s3"),
                                  ("out", "d", "blob", None)], LITERALS)
    got = ds.task_datasets(chain, lits)
    assert sorted((r.workflow_id, r.task_index, r.direction, r.dataset_name, r.schema_uri) for r in got.collect()) == [
        ("v", 0, "o", "p.t.o0", "s2"), ("w", 0, "i", "p.t0.i0", "s1"), ("w", 0, "o", "p.t0.o0", "s2")]
    assert plan(got).count("Relation [") == 1


def test_verdicts_at_the_cut_equal_the_gate_over_what_is_emitted(spark):
    toks = "r r r r S T0 N0 W4".split()
    ev = events_frame(spark, {"a": toks, "b": toks[:4] + ["T0", "N1", "W4", "r"], "c": ["r", "T0", "N0", "W4", "r", "r", "r", "r"],
                              "d": ["T0", "W4"]})
    emitted, cuts = rp.prefix_events(ev)
    columns = ["workflow_id", "n_events", "n_wf_success", "n_task_ok", "n_node_ok", "reason", "accepted", "build", "built"]
    want = sorted(map(tuple, gt.gate(emitted).select(*columns).collect()))
    assert sorted(map(tuple, rp.cut_verdicts(cuts).select(*columns).collect())) == want and len(want) == 3


def test_schema_history_reads_its_names_once(spark):
    names = landed(spark, spark.createDataFrame(
        [("w1", 0, 0, "d.t", "s1", 1, "db", "t", "p"), ("w2", 0, 0, "d.t", "s2", 2, "db", "t", "p"), ("w3", 0, 0, "d.t", "s2", 3, "db", "t", "p")],
        "workflow_id string, slot long, ordinal long, dataset_name string, schema_uri string, created_ns long, db string, "
        "table_name string, path string"))
    texts = spark.createDataFrame([("s1", "a:int"), ("s2", "a:long")], "schema_uri string, fields_text string")
    history = cat.schema_history(names, texts)
    assert "Relation [" not in plan(history)
    assert sorted((r.version, r.since_ns, r.fields_text) for r in history.collect()) == [(1, 1, "a:int"), (2, 2, "a:long")]


def slow_cuts(rows):
    """Cuts of sorted (run, seq, wf, task, node) rows, an arrival at a time."""
    from eventweave.operators.run_gate import RunGate
    out, run = [], None
    for at, (key, seq, wf, task, node) in enumerate(rows):
        if key != run:
            run, gate, seqs = key, RunGate(), []
        seqs.append(seq)
        epoch, cut = gate.epoch, gate.step(seq, wf, task, node)
        if cut:
            same = next((k for k, s in enumerate(reversed(seqs)) if s != seq), len(seqs))
            tied = at + 1 < len(rows) and rows[at + 1][:2] == (key, seq)
            out.append((key, epoch, *cut, same, tied))
    return out


def random_rows(seed, runs):
    import random
    pick, rows = random.Random(seed), []
    for k in range(runs):
        seq = 0
        for _ in range(pick.randint(1, 30)):
            seq += pick.random() < 0.6
            kind = pick.choice(["w", "t", "n", "-", "-"])
            node = f"n{pick.randint(0, 2)}" if kind == "n" else None
            rows.append((f"r{k:04d}", seq, kind == "w" and pick.random() < 0.5, kind == "t", node))
    return rows


def arrow_batches(rows, names, n):
    import pyarrow as pa
    kinds = {"workflow_id": pa.string(), "node": pa.string(), "wf": pa.bool_(), "task": pa.bool_(), "rank": pa.int32()}
    for a in range(0, len(rows), n):
        yield pa.RecordBatch.from_arrays([pa.array(col, type=kinds.get(k, pa.int64())) for k, col in zip(names, zip(*rows[a:a + n]))],
                                         names=names)


def test_skipped_stretches_give_the_cuts_of_single_arrivals():
    from eventweave.operators import run_gate
    for seed, n in ((1, 1), (2, 7), (3, 50), (4, 10_000)):
        rows = random_rows(seed, 300)
        got = [tuple(r.values()) for b in run_gate.replay(arrow_batches(rows, ["workflow_id", "arrival_seq", "wf", "task", "node"], n), 20)
               for r in b.to_pylist()]
        assert got == slow_cuts(rows) and len(got) > 50
        names = [f.split()[0] for f in run_gate.RESUMED.split(", ")]
        full = [(r[0], 2, r[1], r[2], r[3], r[4], *[None] * 6, r[1]) for r in rows]
        left = [r for b in run_gate.resume(3, None, 20)(arrow_batches(full, names, n)) for r in b.to_pylist()]
        assert [(r["workflow_id"], r["epoch"], r["start_seq"], r["cut_seq"], r["n"]) for r in left if r["kind"] == "cut"] == [
            (r[0], r[1], r[2], r[3], r[4]) for r in got]
        assert sum(r["kind"] == "run" for r in left) == 300


def test_arrivals_that_cannot_cut_are_not_stepped(monkeypatch):
    from eventweave.operators import run_gate
    steps = []
    plain = run_gate.RunGate.step
    monkeypatch.setattr(run_gate.RunGate, "step", lambda self, *a: steps.append(a) or plain(self, *a))
    rows = [("r", k, False, k % 2 == 0, f"n{k}" if k % 2 else None) for k in range(1000)] + [("r", 1000, True, False, None)]
    out = [r for b in run_gate.replay(arrow_batches(rows, ["workflow_id", "arrival_seq", "wf", "task", "node"], 100)) for r in b.to_pylist()]
    assert [(r["n_emitted"], r["n_task_ok"], r["n_node_canon"]) for r in out] == [(1001, 500, 500)] and len(steps) < 5


def test_rounds_over_a_backlog_grow_with_what_is_done(spark):
    from eventweave.sources import envelope as envl
    from eventweave.streaming import gate_stream as gs
    base = f"{checkpoint_dir(spark)}/rounds-{uuid.uuid4().hex}"
    ev = events_frame(spark, {"p": "r r r r S T0 N0 W4".split() * 3})
    gs.land_envelopes(ev, f"{base}/landing", 12, lambda rows: envl.encode(rows, "range"))
    gate = gs.run_stream(spark, f"{base}/landing", f"{base}/gate")
    assert gate._batches("rounds") == [1, 2, 3, 4, 5, 6, 7, 8, 10, 12]
    assert sorted((r.epoch, r.cut_seq, r.n_emitted) for r in gate.cuts().collect()) == [(1, 7, 8), (2, 15, 8), (3, 23, 8)]


def test_a_log_encoded_behind_the_exchange_has_the_same_envelopes(spark):
    from eventweave.plans import queries as q
    from eventweave.sources import envelope_log
    root = f"{checkpoint_dir(spark)}/encoded-{uuid.uuid4().hex}"
    q._land_log(spark, SF001, root)
    log = spark.read.parquet(root).select("body", "arrival_seq")
    want = q.envelopes(spark, SF001)
    assert log.count() == want.count() > 0 and log.exceptAll(want).isEmpty()
    local = root.removeprefix("file:")
    seqs = [r for f in envelope_log.log_files(local) for r in [spark.read.parquet(f).selectExpr("min(arrival_seq)", "max(arrival_seq)").first()]]
    assert all(a[1] <= b[0] for a, b in zip(seqs, seqs[1:])) and len(seqs) == 8


def test_reject_rows_leave_the_payload_columns_alone(spark):
    from eventweave.sources import envelope as envl
    _, bad = envl.decode(spark.createDataFrame([("{", 1)], envl.ENVELOPE_SCHEMA))
    assert "task_version" not in plan(bad) and [r.reason for r in bad.collect()] == ["invalid_envelope"]
