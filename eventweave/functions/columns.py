"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventweave.options import DEFAULT, LineageOptions

# Python's int() accepts surrounding whitespace, a sign and single
# underscores between digits; everything else falls back to 0.
_INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
_CANON_NODE = r"^n(0|[1-9][0-9]{0,17})$"


def c(name: str) -> Column:
    return F.col(name)


# --- event predicates (always on (kind, phase): codes differ per kind) -----

def is_task_ok(o: LineageOptions = DEFAULT) -> Column:
    return F.coalesce((c("kind") == "task") & (c("phase") == o.task_node_succeeded), F.lit(False))


def is_node_ok(o: LineageOptions = DEFAULT) -> Column:
    return F.coalesce((c("kind") == "node") & (c("phase") == o.task_node_succeeded)
                      & ~F.coalesce(c("node_id"), F.lit("")).endswith(o.node_suffix_excluded), F.lit(False))


def is_wf_success(o: LineageOptions = DEFAULT) -> Column:
    return F.coalesce((c("kind") == "workflow")
                      & c("phase").isin(o.workflow_succeeding, o.workflow_succeeded)
                      & F.coalesce(c("wf_output_uri"), F.lit("")).contains(o.end_node_marker), F.lit(False))


def canonical_node_index(node_id: Column) -> Column:
    """i for a node id spelled exactly ``n{i}``, else NULL."""
    return F.when(node_id.rlike(_CANON_NODE), F.substring(node_id, 2, 19).cast("bigint"))


# --- value conversions ------------------------------------------------------

def version_number(v: Column) -> Column:
    """Task version text -> BIGINT the way Python's int() reads it, else 0."""
    cleaned = F.regexp_replace(v, r"[\s_]", "")
    return F.coalesce(F.when(v.rlike(_INT_TEXT), cleaned.try_cast("bigint")),
                      F.lit(0)).cast("bigint")


def int_div(x: Column, d: int) -> Column:
    """Exact floor division of a BIGINT (a double would lose digits above 2^53)."""
    return F.floor(x.cast("decimal(20,0)") / F.lit(d)).cast("bigint")


def ns_to_text(ns: Column) -> Column:
    """Epoch ns -> Python ``str(datetime)`` in UTC: no fraction when zero, else 6 digits.

    The session's time zone plays no part: the text comes from a timestamp without zone.
    """
    micros = int_div(ns, 1000)
    frac = F.pmod(micros, F.lit(1_000_000))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.make_dt_interval(secs=F.floor(micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    base = F.substring((epoch + seconds).cast("string"), 1, 19)
    return F.when(frac == 0, base).otherwise(
        F.concat(base, F.lit("."), F.lpad(frac.cast("string"), 6, "0")))


def ns_to_millis(ns: Column) -> Column:
    """Epoch ns -> epoch ms (audit stamp time)."""
    return int_div(ns, 1_000_000)


def first_or_empty(arr: Column) -> Column:
    return F.coalesce(F.get(arr, 0), F.lit(""))


def before_last_dot(s: Column) -> Column:
    """``str.rpartition('.')[0]``: text up to the final dot, '' without one."""
    return F.regexp_extract(s, r"^(.*)\.[^.]*$", 1)


def before_first_dash(s: Column) -> Column:
    return F.split(s, "-").getItem(0)


# --- URNs (metadata service naming) -----------------------------------------

def dataset_urn(name: Column, o: LineageOptions = DEFAULT) -> Column:
    return F.concat(F.lit(f"urn:li:dataset:(urn:li:dataPlatform:{o.platform},"), name,
                    F.lit(f",{o.env})"))


def flow_urn(name: Column, o: LineageOptions = DEFAULT) -> Column:
    return F.concat(F.lit(f"urn:li:dataFlow:({o.platform},"), name, F.lit(f",{o.env})"))


def job_urn(flow: Column, task: Column, o: LineageOptions = DEFAULT) -> Column:
    return F.concat(F.lit("urn:li:dataJob:("), flow_urn(flow, o), F.lit(","), task, F.lit(")"))


def tag_urn(tag: Column) -> Column:
    return F.concat(F.lit("urn:li:tag:"), tag)


def user_urn(user: Column) -> Column:
    return F.concat(F.lit("urn:li:corpuser:"), user)
