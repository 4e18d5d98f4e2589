"""Snapshot and prefix gates on the hand cases of FIXTURES.md §2."""

import pytest

from eventweave.operators import chain as ch
from eventweave.operators import gate as gt
from eventweave.operators import replay as rp
from helpers import events_frame

CASES = {
    "c1": "r r S T0 N0 E r W4",
    "c2": "S T0 N0 E W4",
    "c3": "r r S T0 N0 E r W3 W4",
    "c4": "r r r S T0 T0 N0 E W4",
    "c5": "r r r S T0 N0 N0 E W4",
    "c6": "r r r r S E W4 T0 N0",
    "c7": "r r r r r S E W4",
    "c8": "r r r S T0 N1 E W4",
    "c9": "r r r S T0 N0 E W4x",
    "c12": "S N0 N1 T1 E r r W4",
}
# run -> (snapshot accepted, snapshot build)
SNAPSHOT = {
    "c1": (True, "ok"), "c2": (False, None), "c3": (False, None), "c4": (False, None),
    "c5": (True, "ok"), "c6": (True, "ok"), "c7": (True, "no_tasks"),
    "c8": (True, "missing_node"), "c9": (False, None), "c12": (False, None),
}
# run -> (first cut n_emitted, accepted) ; absent = never completes
PREFIX = {
    "c1": (8, True), "c2": (5, False), "c3": (8, True), "c5": (9, True), "c6": (7, False),
    "c7": (8, True), "c8": (8, True),
}


@pytest.fixture(scope="module")
def events(spark):
    return events_frame(spark, {k: v.split() for k, v in CASES.items()})


def test_snapshot_gate(events):
    got = {r.workflow_id.split("-")[-1]: (r.accepted, r.build)
           for r in gt.gate(events).collect()}
    assert got == SNAPSHOT


def test_snapshot_reasons(events):
    got = {r.workflow_id.split("-")[-1]: r.reason for r in gt.gate(events).collect()}
    assert got["c2"] == "too_few_events"
    assert got["c3"] == "multiple_success_events"
    assert got["c4"] == "task_node_mismatch"
    assert got["c9"] == "no_success_event"
    assert got["c12"] == "task_node_mismatch"


def test_prefix_first_epoch(events):
    _, cuts = rp.prefix_cut(events)
    got = {r.workflow_id.split("-")[-1]: (r.n_emitted, r.accepted) for r in cuts.collect()}
    assert got == PREFIX


def test_prefix_epochs_residual(events):
    got = {(r.workflow_id.split("-")[-1], r.epoch): r.n_emitted
           for r in rp.prefix_epochs(events).collect()}
    # c3: W4 is left over after the cut at W3 and completes alone (0 = 0), too short
    assert got[("c3", 2)] == 1
    # c6: T0 N0 arrive after the cut at W4 and never complete again
    assert ("c6", 2) not in got


def test_chain_snapshot(events):
    chain = ch.task_chain(events, gt.gate(events))
    got = sorted((r.workflow_id.split("-")[-1], r.task_index, r.task_name, r.upstream_task)
                 for r in chain.collect())
    assert got == [("c1", 0, "pkg.wf.t0", None), ("c5", 0, "pkg.wf.t0", None),
                   ("c6", 0, "pkg.wf.t0", None)]


def test_time_order_ties_keep_arrival(spark):
    toks = "r r S T0 T1 N0 N1 E W4".split()
    same = {("a", 3): 5_000, ("a", 4): 5_000}           # equal ns: arrival order
    apart = {("b", 3): 5_001, ("b", 4): 5_000}          # 1 ns apart: time order
    ev = events_frame(spark, {"a": toks}, same).unionByName(
        events_frame(spark, {"b": toks}, apart))
    chain = ch.task_chain(ev, gt.gate(ev))
    got = {(r.workflow_id[-1], r.task_index): (r.task_name, r.upstream_task)
           for r in chain.collect()}
    assert got[("a", 0)] == ("pkg.wf.t0", None)
    assert got[("a", 1)] == ("pkg.wf.t1", "pkg.wf.t0")
    assert got[("b", 0)] == ("pkg.wf.t1", None)
    assert got[("b", 1)] == ("pkg.wf.t0", "pkg.wf.t1")
