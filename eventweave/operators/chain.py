"""Task chain of a run: order, index, upstream, projection and pipeline header.

Only successful task events of built runs take part. Positions come from
``ordered_scan`` keyed by the run and split into time sub-ranges for runs
with many tasks, so a single huge run is sorted by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.functions.columns import (
    before_first_dash, before_last_dot, c, first_or_empty, is_task_ok, ns_to_text,
    version_number)
from eventweave.operators.gate import keep_events
from eventweave.operators.ordering import ordered_scan, split_hot
from eventweave.options import DEFAULT, LineageOptions
from eventweave.session import land

# Time order of events; ties keep arrival order, then any remaining column.
TIME_ORDER = ["occurred_at_ns", "arrival_seq", "kind", "phase", "node_id", "task_name",
              "generated_name", "wf_output_uri", "task_version", "input_uri", "output_uri"]
ARRIVAL_ORDER = ["arrival_seq", "kind", "phase", "occurred_at_ns", "node_id", "task_name",
                 "generated_name", "wf_output_uri", "task_version", "input_uri", "output_uri"]


def order_cols(names: list[str]):
    return [F.col(n).asc_nulls_first() for n in names]


def event_positions(events: DataFrame, verdict: DataFrame, column: str | None,
                    o: LineageOptions = DEFAULT, columns: list[str] | None = None) -> DataFrame:
    """Every event of the selected runs with its 0-based time position.

    With ``columns`` only those of the events are shuffled, sorted and returned: events
    of a run that agree on them are interchangeable, whatever orders them further.
    """
    order = [k for k in TIME_ORDER if columns is None or k in columns]
    if columns is not None:
        # the order's columns side by side in a row, which packs best
        events = events.select(*dict.fromkeys([*order, *columns, "workflow_id"]))
    ev = events if column is None else events.join(
        verdict.filter(c(column)).select("workflow_id"), "workflow_id", "left_semi")
    ev, bucket = split_hot(ev, "workflow_id", "occurred_at_ns", o.hot_group_rows) if _any_hot(
        verdict, "n_events", o) else (ev, None)
    return ordered_scan(ev, "workflow_id", order_cols(order), bucket=bucket, pos_col="event_pos")


def _any_hot(verdict: DataFrame, counted: str, o: LineageOptions) -> bool:
    """Whether a run of the verdicts is large enough to be split; reads one row per run."""
    return not verdict.filter(c(counted) > o.hot_group_rows).isEmpty()


def task_chain(events: DataFrame, verdict: DataFrame, o: LineageOptions = DEFAULT,
               column: str = "built") -> DataFrame:
    """Successful tasks of built runs with index and upstream task name.

    ``verdict`` should be materialised: it is read once to decide whether any
    run is large enough to need the ordered split, and again for the join.
    """
    # landed, so the planner knows from its size whether to broadcast it
    kept = land(verdict.filter(c(column)).select("workflow_id", column, "n_task_ok"))
    tasks = keep_events(events.filter(is_task_ok(o)), kept, column, extra=("n_task_ok",))
    tasks, bucket = split_hot(tasks, "workflow_id", "occurred_at_ns", o.hot_group_rows) if _any_hot(
        kept, "n_task_ok", o) else (tasks, None)
    return ordered_scan(tasks, "workflow_id", order_cols(TIME_ORDER), bucket=bucket,
                        prev={"upstream_task": "task_name"}, pos_col="task_index")


def task_projection(chain: DataFrame) -> DataFrame:
    """The Task record of each chained task, flat."""
    return chain.select(
        "workflow_id",
        "task_index",
        c("generated_name").alias("task_id"),
        "task_name",
        first_or_empty(c("log_uris")).alias("url"),
        version_number(c("task_version")).alias("version"),
        F.coalesce(c("input_uri"), F.lit("")).alias("input_uri_args"),
        F.coalesce(c("output_uri"), F.lit("")).alias("output_uri_args"),
        ns_to_text(c("occurred_at_ns")).alias("completed"),
        F.coalesce(c("task_version"), F.lit("")).alias("version_text"),
    )


def task_metadata(proj: DataFrame) -> DataFrame:
    """The Task metadata map (four entries, raw version text)."""
    return proj.withColumn("metadata", F.create_map(
        F.lit("input_uri_args"), c("input_uri_args"),
        F.lit("output_uri_args"), c("output_uri_args"),
        F.lit("completed"), c("completed"),
        F.lit("version"), c("version_text")))


def pipeline_header(chain: DataFrame) -> DataFrame:
    """One row per run: pipeline name, id and task count.

    name = last task's ``domain.project.`` + its name up to the final dot;
    id = first task's generated name up to the first dash.
    """
    agg = chain.groupBy("workflow_id").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.min_by("generated_name", "task_index").alias("_first_gen"),
        F.max_by(F.struct("task_domain", "task_project", "task_name"), "task_index").alias("_last"),
    )
    last = c("_last")
    return agg.select(
        "workflow_id",
        F.concat_ws(".", last["task_domain"], last["task_project"],
                    before_last_dot(last["task_name"])).alias("pipeline_name"),
        before_first_dash(c("_first_gen")).alias("pipeline_id"),
        "n_tasks",
    )
