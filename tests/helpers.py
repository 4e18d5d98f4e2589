"""Hand-made execution events for the gate cases of FIXTURES.md §2."""

from eventweave.schemas import EXEC_EVENTS

SF001 = "/root/testdata/sf0.001"
END_URI = "s3://meta/x/end-node/data/outputs.pb"


def token_event(tok: str):
    """(kind, phase, node_id, wf_output_uri, task_name) of one notation token."""
    if tok == "r":
        return ("task", 1, None, None, "pkg.wf.queued")
    if tok == "S":
        return ("node", 3, "start-node", None, None)
    if tok == "E":
        return ("node", 3, "end-node", None, None)
    if tok in ("W3", "W4"):
        return ("workflow", int(tok[1]), None, END_URI, None)
    if tok == "W4x":
        return ("workflow", 4, None, "s3://meta/x/other/outputs.pb", None)
    if tok.startswith("T"):
        return ("task", 3, None, None, f"pkg.wf.t{tok[1:]}")
    if tok.startswith("N"):
        return ("node", 3, f"n{tok[1:]}", None, None)
    raise ValueError(tok)


def events_frame(spark, runs: dict[str, list], ns: dict | None = None):
    """runs: run name -> tokens in arrival order; ns: (run, position) -> occurred ns."""
    ns = ns or {}
    rows = []
    for run, toks in runs.items():
        for i, tok in enumerate(toks):
            kind, phase, node, uri, task = token_event(tok)
            is_task = kind == "task"
            rows.append((
                kind, "proj", "dev", run, f"proj-dev-{run}", phase,
                ns.get((run, i), 1_000_000_000 * (i + 1)), i, node, uri, task,
                "7" if is_task else None, "proj" if is_task else None,
                "dev" if is_task else None, f"{run}-n{i}-0" if is_task else None,
                f"s3://meta/{run}/n{i}/inputs.pb" if is_task else None,
                f"s3://meta/{run}/n{i}/outputs.pb" if is_task else None,
                [f"https://logs/{run}/{i}"] if is_task else None))
    return spark.createDataFrame(rows, EXEC_EVENTS)
