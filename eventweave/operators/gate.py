"""Completeness gate of a run (snapshot semantics) and the event keep-set.

Snapshot = the reference's completeness predicate evaluated over all events
of a run: exactly one workflow success event whose output URI names the end
node, as many successful task events as distinct successful node ids, and
more than 7 events. Events are counted per run and word of 64 successful nodes first
and then per run, both with partial aggregation before the shuffle, so a run
with a huge share of the events costs a few pre-aggregated rows per map task,
and distinct nodes are just bits of the first step's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.functions.columns import (
    c, canonical_node_index, is_node_ok, is_task_ok, is_wf_success)
from eventweave.options import DEFAULT, LineageOptions

# Fixed reason codes of the gate, first failing test wins.
REASONS = ("no_success_event", "multiple_success_events", "task_node_mismatch",
           "too_few_events", "too_few_tasks", "complete")


def run_stats(events: DataFrame, o: LineageOptions = DEFAULT) -> DataFrame:
    """One row per run with every count the gate and the chain need."""
    task_ok, node_ok = is_task_ok(o), is_node_ok(o)
    # Nodes n{i} are bits of words of 64, so a run of a few nodes is one row of a
    # map task and a huge one spreads by its words; other nodes are rows each.
    ev = (events.select("workflow_id", "occurred_at_ns", F.when(node_ok, c("node_id")).alias("_ok"),
                        is_wf_success(o).alias("_wf_ok"), task_ok.alias("_task_ok"))
          .withColumn("_canon", canonical_node_index(c("_ok")))
          .withColumn("_idx", F.when(F.concat(F.lit("n"), c("_canon").cast("string")) == c("_ok"), c("_canon")))
          .withColumn("_node", F.when(c("_idx").isNull(), c("_ok"))))
    word = F.coalesce(F.shiftright("_idx", 6), F.lit(0).cast("bigint"))
    per_node = ev.groupBy("workflow_id", word.alias("_word"), "_node").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_wf_ok").alias("_wf"),
        F.count_if("_task_ok").alias("_task"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (c("_idx") % 64).cast("int"))).alias("_bits"),
        F.max("_idx").alias("_last"),
        F.min("occurred_at_ns").alias("_min"),
        F.max("occurred_at_ns").alias("_max"))
    canon = canonical_node_index(c("_node"))
    spelled_nodes = F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0))
    return per_node.groupBy("workflow_id").agg(
        F.sum("_n").alias("n_events"),
        F.sum("_wf").alias("n_wf_success"),
        F.sum("_task").alias("n_task_ok"),
        (F.count("_node") + spelled_nodes).alias("n_node_ok"),
        (F.count(canon) + spelled_nodes).alias("n_node_canon"),
        F.max(F.greatest("_last", canon)).alias("max_node_idx"),
        F.min("_min").alias("ns_min"),
        F.max("_max").alias("ns_max"))


def decide(stats: DataFrame, o: LineageOptions = DEFAULT) -> DataFrame:
    """Add the gate's verdict columns to ``run_stats`` output."""
    wf_ok = c("n_wf_success") == 1
    parity = c("n_task_ok") == c("n_node_ok")
    long_enough = c("n_events") > o.min_events_exclusive
    enough_tasks = c("n_task_ok") >= o.min_tasks
    reason = (F.when(c("n_wf_success") == 0, F.lit(REASONS[0]))
              .when(c("n_wf_success") > 1, F.lit(REASONS[1]))
              .when(~parity, F.lit(REASONS[2]))
              .when(~long_enough, F.lit(REASONS[3]))
              .when(~enough_tasks, F.lit(REASONS[4]))
              .otherwise(F.lit(REASONS[5])))
    # Task i pairs with node n{i}: with parity the k distinct node ids must be
    # exactly n0..n{k-1}, i.e. all canonical and the largest index is k-1.
    paired = (c("n_node_canon") == c("n_task_ok")) & (
        F.coalesce(c("max_node_idx"), F.lit(-1)) == c("n_task_ok") - 1)
    if not o.strict_nodes:
        paired = F.lit(True)
    accepted = wf_ok & parity & long_enough & enough_tasks
    build = (F.when(~accepted, F.lit(None).cast("string"))
             .when(c("n_task_ok") == 0, F.lit("no_tasks"))
             .when(~paired, F.lit("missing_node"))
             .otherwise(F.lit("ok")))
    return (stats.withColumn("is_successful", wf_ok)
            .withColumn("parity", parity)
            .withColumn("complete", wf_ok & parity)
            .withColumn("reason", reason)
            .withColumn("accepted", accepted)
            .withColumn("build", build)
            .withColumn("built", F.coalesce(build == "ok", F.lit(False))))


def gate(events: DataFrame, o: LineageOptions = DEFAULT) -> DataFrame:
    return decide(run_stats(events, o), o)


def keep_events(events: DataFrame, verdict: DataFrame, column: str = "accepted",
                extra: tuple[str, ...] = ()) -> DataFrame:
    """Events of runs whose verdict ``column`` holds (semi join on the run)."""
    runs = verdict.filter(c(column)).select("workflow_id", *extra)
    if extra:
        return events.join(runs, "workflow_id")
    return events.join(runs, "workflow_id", "left_semi")
