"""The gate counts the nodes n{i} of a run by words of bits."""

from eventweave.operators import gate as gt

EVENTS = "workflow_id string, kind string, phase int, node_id string, wf_output_uri string, occurred_at_ns long"


def test_nodes_of_a_run_are_counted_by_words(spark):
    nodes = {"a": ["n0", "n1", "n1", "n63", "n64", "n127"], "b": ["n5", "n5\n", "n05", "x", "x", "", None, "end-node"],
             "c": ["n999999999999999999", "n1000000000000000000", "n-1"], "d": [None], "e": [f"n{i}" for i in range(300)] * 2}
    ev = spark.createDataFrame([(w, "node", 3, n, None, i) for w, names in nodes.items() for i, n in enumerate(names)]
                               + [("a", "task", 3, None, None, 9), ("a", "workflow", 4, None, "s3://x/end-node/o", 11)], EVENTS)
    stats = gt.run_stats(ev)
    got = {r.workflow_id: tuple(r)[1:] for r in stats.collect()}
    # events, workflow successes, tasks, nodes, of them n{i}, the largest i, times
    assert got == {"a": (8, 1, 1, 5, 5, 127, 0, 11), "b": (8, 0, 0, 5, 2, 5, 0, 7),
                   "c": (3, 0, 0, 3, 1, 999999999999999999, 0, 2), "d": (1, 0, 0, 0, 0, None, 0, 0),
                   "e": (600, 0, 0, 300, 300, 299, 0, 599)}
    assert "bit_or" in stats._jdf.queryExecution().optimizedPlan().toString()
