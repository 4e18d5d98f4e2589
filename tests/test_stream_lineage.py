"""Streaming lineage fan-out equals the batch prefix lineage (first epochs)."""

from helpers import SF001

from eventweave.operators import replay as rp
from eventweave.plans import lineage as ln
from eventweave.plans import queries as Q


def test_stream_lineage_matches_batch_prefix(spark):
    stream = Q.stream_lineage(spark, SF001)
    s = sorted((r.workflow_id.split("#")[0], r.entity_type, r.urn, r.n_aspects)
               for r in stream.filter("workflow_id LIKE '%#1'").collect())
    emitted, _ = rp.prefix_events(Q._events(spark, SF001))
    frames = ln.build(spark, emitted, Q.adapter.literals(spark, SF001), Q._profiles(spark, SF001))
    b = sorted((r.workflow_id, r.entity_type, r.urn, len(r.aspects)) for r in frames.mce.collect())
    assert s == b
    assert len(b) > 100
