"""Forcing every run through the hot (split) path changes no result."""

from dataclasses import replace

from helpers import SF001

from eventweave.operators import chain as ch
from eventweave.operators import gate as gt
from eventweave.operators import replay as rp
from eventweave.options import DEFAULT
from eventweave.sources import adapter

HOT = replace(DEFAULT, hot_group_rows=2)


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_chain_hot_equals_plain(spark):
    ev = adapter.exec_events(spark, SF001)
    v = gt.gate(ev).checkpoint()
    cols = ["workflow_id", "task_index", "task_name", "upstream_task"]
    plain = rows(ch.task_chain(ev, v), cols)
    assert plain == rows(ch.task_chain(ev, v, HOT), cols)
    assert len(plain) == 45


def test_prefix_and_positions_hot_equal_plain(spark):
    ev = adapter.exec_events(spark, SF001)
    _, c1 = rp.prefix_cut(ev)
    _, c2 = rp.prefix_cut(ev, HOT)
    cols = ["workflow_id", "cut_pos", "cut_seq"]
    assert rows(c1, cols) == rows(c2, cols)
    st = gt.run_stats(ev).checkpoint()
    pc = ["workflow_id", "event_pos", "arrival_seq", "kind", "phase"]
    assert rows(ch.event_positions(ev, st, None), pc) == rows(ch.event_positions(ev, st, None, HOT), pc)
