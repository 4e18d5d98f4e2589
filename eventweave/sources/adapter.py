"""Driver tables -> execution events and literal maps.

The driver's tables hold no execution events, so an order becomes a workflow
run and a line item becomes a task on a node. The DuckDB oracle builds the
same rows with the same expressions (``eventweave.plans.oracle``).

Plan shape: one scan of ``orders`` joined to ``customer`` (the planner picks
broadcast or shuffle from size statistics, AQE re-checks at run time) and to
the fixed-size ``nation``/``region`` pair; one scan of ``lineitem`` joined to
the runs on the order key. Each input row fans out into its numbered events by one
``explode``, so no table is scanned twice for the different event kinds; the
events' columns are expressions above it, so only those that a query reads are
worked out, and only for the events it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventweave.schemas import EXEC_EVENT_COLUMNS
from eventweave.sources.tables import TABLES, read_table

# Fixed values of the adapter (FIXTURES.md §3).
RUN_SPAN_NS = 10 ** 17
SEQ_SUCCEEDED = 900000000000000
SEQ_SUCCEEDING = 899999999999999
SEQ_END_NODE = 800000000000000
URI_ROOT = "s3://meta/"
LOG_ROOT = "https://logs.example/"
DATASET_SCHEME = "dataset://"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the run's identity and start time.

    ``nation``/``region`` are fixed-size dimensions; no hint is given, the
    planner broadcasts them from their file-size statistics (and would
    shuffle-join them if they were above the broadcast threshold).
    """
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_orderdate")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey", "lower(r_name) AS project")
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey).selectExpr(
        "c_custkey", "project", "lower(c_mktsegment) AS domain")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).selectExpr(
        "o_orderkey AS k", "project", "domain",
        f"{_EXEC_NAME.format('o_orderkey')} AS exec_name",
        "o_orderstatus AS status",
        f"{_NS.format('o_orderdate')} AS t0",
    ).selectExpr("k", "project", "domain", "exec_name", "status", "t0", f"{_RUN_KEY} AS workflow_id")


_EXEC_NAME = "concat('o', CAST({} AS STRING))"
_RUN_KEY = "concat_ws('-', project, domain, exec_name)"
# timestamp_ntz -> epoch nanoseconds (session zone is UTC)
_NS = "unix_micros(CAST({} AS TIMESTAMP)) * 1000"
_TASK_FIELDS = ("task_name", "task_version", "task_project", "task_domain", "generated_name",
                "input_uri", "output_uri", "log_uris")


def _fan_out(df: DataFrame, run_cols: list[str], n: int, keep: str, columns: dict[str, str]) -> DataFrame:
    """``n`` rows of each row, numbered ``e``, where ``keep`` holds; columns are worked out per kept row."""
    numbers = ", ".join(str(i) for i in range(n))
    return df.selectExpr("*", f"explode(array({numbers})) AS e").where(keep).selectExpr(
        *run_cols, *[f"{text} AS {name}" for name, text in columns.items()])


def exec_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All execution events of all runs (schema ``EXEC_EVENTS``)."""
    wf = runs(spark, sf_dir)
    run_cols = ["project", "domain", "exec_name", "workflow_id"]
    end_uri = f"concat('{URI_ROOT}', exec_name, '/end-node/data/outputs.pb')"
    # 0 start, 1 success, 2 succeeding, 3 start node, 4 end node
    run_events = _fan_out(
        wf, run_cols, 5, "CASE e WHEN 1 THEN status IN ('F', 'P') WHEN 2 THEN status = 'F' AND k % 13 = 0 ELSE TRUE END", {
            "kind": "CASE WHEN e < 3 THEN 'workflow' ELSE 'node' END",
            "phase": "CASE e WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 3 END",
            "occurred_at_ns": f"t0 + CASE e WHEN 1 THEN {RUN_SPAN_NS} WHEN 2 THEN {RUN_SPAN_NS - 1}"
                              f" WHEN 4 THEN {RUN_SPAN_NS - 2} ELSE 0L END",
            "arrival_seq": f"CASE e WHEN 0 THEN 0L WHEN 1 THEN {SEQ_SUCCEEDED} WHEN 2 THEN {SEQ_SUCCEEDING}"
                           f" WHEN 3 THEN 1L ELSE {SEQ_END_NODE} END",
            "node_id": "CASE e WHEN 3 THEN 'start-node' WHEN 4 THEN 'end-node' END",
            "wf_output_uri": f"CASE WHEN e = 1 AND k % 17 = 0 THEN '' WHEN e IN (1, 2) THEN {end_uri} END",
            **{f: "CAST(NULL AS STRING)" for f in _TASK_FIELDS[:-1]}, "log_uris": "CAST(NULL AS ARRAY<STRING>)"})

    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    # the exchange before the join gets what the events need of a line, and of a run no text made of its key
    lines = li.selectExpr(
        "l_orderkey",
        "CAST(l_linenumber AS BIGINT) AS line", "CAST(l_partkey AS BIGINT) AS part",
        "CAST(l_suppkey AS BIGINT) AS supp",
        f"{_NS.format('l_shipdate')} + CAST(l_linenumber AS BIGINT) * 1000000000 AS base",
        "NOT (l_returnflag = 'R' AND l_quantity >= 49) AS task_ok")
    lw = lines.join(wf.select("k", "project", "domain"), lines.l_orderkey == wf.k).selectExpr(
        "*", f"{_EXEC_NAME.format('k')} AS exec_name").selectExpr(
        "project", "domain", "exec_name", f"{_RUN_KEY} AS workflow_id", "part", "supp", "base", "task_ok",
        "line * 100000000000 + part * 100000 + supp * 10 AS seq",
        "concat('n', CAST(line - 1 AS STRING)) AS node_id",
    ).selectExpr(
        *run_cols, "base", "seq", "node_id", "task_ok",
        "concat('seg', CAST(supp % 5 AS STRING), '.etl.part', CAST(part AS STRING)) AS task_name",
        "CASE supp % 4 WHEN 0 THEN CAST(supp AS STRING) WHEN 1 THEN concat('v', CAST(supp AS STRING))"
        " WHEN 2 THEN concat(' ', CAST(supp AS STRING)) ELSE '' END AS task_version",
        "project AS task_project", "domain AS task_domain",
        "concat(exec_name, '-', node_id, '-0') AS generated_name",
        f"concat('{URI_ROOT}', exec_name, '/', node_id, '/inputs.pb') AS input_uri",
        f"CASE WHEN part % 5 = 0 THEN NULL ELSE concat('{URI_ROOT}', exec_name, '/', node_id,"
        " '/outputs.pb') END AS output_uri",
        f"CASE WHEN supp % 3 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array(concat("
        f"'{LOG_ROOT}', exec_name, '/', node_id)) END AS log_uris",
    )
    # 0 task running, 1 node running, 2 task succeeded, 3 node succeeded
    line_events = _fan_out(lw, run_cols, 4, "e <> 2 OR task_ok", {
        "kind": "CASE WHEN e % 2 = 0 THEN 'task' ELSE 'node' END",
        "phase": "CASE WHEN e < 2 THEN 2 ELSE 3 END",
        "occurred_at_ns": "base + e", "arrival_seq": "seq + e",
        "node_id": "CASE WHEN e % 2 = 1 THEN node_id END",
        "wf_output_uri": "CAST(NULL AS STRING)",
        **{f: f"CASE WHEN e % 2 = 0 THEN {f} END" for f in _TASK_FIELDS}})
    return run_events.unionByName(line_events).select(*EXEC_EVENT_COLUMNS)


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal maps stored at the tasks' input and output URIs (schema ``LITERALS``).

    Output map of a line item, by ``l_partkey % 3``: none; one schema; two
    schemas, one blob and one collection. Input map: one schema when
    ``l_suppkey % 2 = 1``. A schema literal points at a driver table.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber")
    names = "array(" + ", ".join(f"'{t}'" for t in TABLES) + ")"

    def table_uri(idx: str) -> str:
        return f"concat('{DATASET_SCHEME}', element_at({names}, CAST(({idx}) % {len(TABLES)} AS INT) + 1))"

    # 0 to 3 in the output map, 4 in the input map
    keep = ("CASE WHEN e = 4 THEN supp % 2 = 1 WHEN part % 5 <> 0 THEN CASE e WHEN 0 THEN part % 3 >= 1"
            " ELSE part % 3 = 2 END END")
    return _fan_out(li.selectExpr(
        "CAST(l_partkey AS BIGINT) AS part", "CAST(l_suppkey AS BIGINT) AS supp",
        f"concat('{URI_ROOT}o', CAST(l_orderkey AS STRING), '/n', CAST(l_linenumber - 1 AS STRING))"
        " AS node_dir",
    ), [], 5, keep, {
        "uri": "concat(node_dir, CASE WHEN e = 4 THEN '/inputs.pb' ELSE '/outputs.pb' END)",
        "var": "CASE e WHEN 0 THEN 'o0' WHEN 1 THEN 'o1' WHEN 2 THEN 'o2' WHEN 3 THEN 'o3' ELSE 'i0' END",
        "kind": "CASE e WHEN 1 THEN 'blob' WHEN 3 THEN 'collection' ELSE 'schema' END",
        "schema_uri": f"CASE e WHEN 0 THEN {table_uri('part')} WHEN 2 THEN {table_uri('part + 7')}"
                      f" WHEN 4 THEN {table_uri('supp')} END"})
