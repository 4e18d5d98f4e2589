"""DuckDB oracle SQL for every query of ``queries.QUERIES`` that SQL expresses.

Tables are the driver's pre-registered views. The common table expressions
rebuild the adapter's events with the same expressions as the Spark code.
Orderings name ``NULLS FIRST`` explicitly (Spark's ascending default).
"""

from __future__ import annotations

# --- adapter -----------------------------------------------------------------

_TASK_NULLS = ("CAST(NULL AS VARCHAR) AS task_name, CAST(NULL AS VARCHAR) AS task_version, "
               "CAST(NULL AS VARCHAR) AS task_project, CAST(NULL AS VARCHAR) AS task_domain, "
               "CAST(NULL AS VARCHAR) AS generated_name, CAST(NULL AS VARCHAR) AS input_uri, "
               "CAST(NULL AS VARCHAR) AS output_uri, CAST(NULL AS VARCHAR[]) AS log_uris")
_TASK_COLS = ("task_name, task_version, project AS task_project, domain AS task_domain, "
              "generated_name, input_uri, output_uri, log_uris")
_RUN = "project, domain, exec_name, workflow_id"


def _ev(kind, phase, ns, seq, node, uri, task, src, where="TRUE"):
    tcols = _TASK_COLS if task else _TASK_NULLS
    return (f"SELECT '{kind}' AS kind, {_RUN}, CAST({phase} AS INTEGER) AS phase, "
            f"CAST({ns} AS BIGINT) AS occurred_at_ns, CAST({seq} AS BIGINT) AS arrival_seq, "
            f"CAST({node} AS VARCHAR) AS node_id, CAST({uri} AS VARCHAR) AS wf_output_uri, "
            f"{tcols} FROM {src} WHERE {where}")


_END_URI = "'s3://meta/' || exec_name || '/end-node/data/outputs.pb'"

EVENTS_CTE = f"""
wf AS (
  SELECT o.o_orderkey AS k, lower(r.r_name) AS project, lower(c.c_mktsegment) AS domain,
         'o' || CAST(o.o_orderkey AS VARCHAR) AS exec_name, o.o_orderstatus AS status,
         epoch_us(o.o_orderdate) * 1000 AS t0
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
wfx AS (SELECT *, project || '-' || domain || '-' || exec_name AS workflow_id FROM wf),
li AS (
  SELECT w.project, w.domain, w.exec_name, w.workflow_id,
         CAST(l.l_linenumber AS BIGINT) AS line, CAST(l.l_partkey AS BIGINT) AS part,
         CAST(l.l_suppkey AS BIGINT) AS supp,
         epoch_us(l.l_shipdate) * 1000 + CAST(l.l_linenumber AS BIGINT) * 1000000000 AS base,
         CAST(l.l_linenumber AS BIGINT) * 100000000000 + CAST(l.l_partkey AS BIGINT) * 100000
           + CAST(l.l_suppkey AS BIGINT) * 10 AS seq,
         'n' || CAST(CAST(l.l_linenumber AS BIGINT) - 1 AS VARCHAR) AS node_id,
         NOT (l.l_returnflag = 'R' AND l.l_quantity >= 49) AS task_ok
  FROM lineitem l JOIN wfx w ON l.l_orderkey = w.k),
lt AS (
  SELECT *,
    'seg' || CAST(supp % 5 AS VARCHAR) || '.etl.part' || CAST(part AS VARCHAR) AS task_name,
    CASE supp % 4 WHEN 0 THEN CAST(supp AS VARCHAR) WHEN 1 THEN 'v' || CAST(supp AS VARCHAR)
      WHEN 2 THEN ' ' || CAST(supp AS VARCHAR) ELSE '' END AS task_version,
    exec_name || '-' || node_id || '-0' AS generated_name,
    's3://meta/' || exec_name || '/' || node_id || '/inputs.pb' AS input_uri,
    CASE WHEN part % 5 = 0 THEN NULL
      ELSE 's3://meta/' || exec_name || '/' || node_id || '/outputs.pb' END AS output_uri,
    CASE WHEN supp % 3 = 0 THEN CAST([] AS VARCHAR[])
      ELSE ['https://logs.example/' || exec_name || '/' || node_id] END AS log_uris
  FROM li),
ev AS (
  {_ev('workflow', 2, 't0', 0, 'NULL', 'NULL', False, 'wfx')}
  UNION ALL {_ev('workflow', 4, 't0 + 100000000000000000', 900000000000000, 'NULL',
                 f"CASE WHEN k % 17 = 0 THEN '' ELSE {_END_URI} END", False, 'wfx',
                 "status IN ('F', 'P')")}
  UNION ALL {_ev('workflow', 3, 't0 + 99999999999999999', 899999999999999, 'NULL', _END_URI,
                 False, 'wfx', "status = 'F' AND k % 13 = 0")}
  UNION ALL {_ev('node', 3, 't0', 1, "'start-node'", 'NULL', False, 'wfx')}
  UNION ALL {_ev('node', 3, 't0 + 99999999999999998', 800000000000000, "'end-node'", 'NULL',
                 False, 'wfx')}
  UNION ALL {_ev('task', 2, 'base', 'seq', 'NULL', 'NULL', True, 'lt')}
  UNION ALL {_ev('node', 2, 'base + 1', 'seq + 1', 'node_id', 'NULL', False, 'lt')}
  UNION ALL {_ev('task', 3, 'base + 2', 'seq + 2', 'NULL', 'NULL', True, 'lt', 'task_ok')}
  UNION ALL {_ev('node', 3, 'base + 3', 'seq + 3', 'node_id', 'NULL', False, 'lt')}
)"""

# --- gate ----------------------------------------------------------------------

TASK_OK = "(kind = 'task' AND phase = 3)"
NODE_OK = "(kind = 'node' AND phase = 3 AND NOT ends_with(coalesce(node_id, ''), '-node'))"
WF_OK = ("(kind = 'workflow' AND phase IN (3, 4) "
         "AND contains(coalesce(wf_output_uri, ''), 'end-node'))")
CANON = "regexp_matches(node_id, '^n(0|[1-9][0-9]{0,17})$')"

def gate_cte(src: str = "ev", p: str = "") -> str:
    return f"""
{p}g AS (
  SELECT workflow_id, count(*) AS n_events,
    count(*) FILTER (WHERE {WF_OK}) AS n_wf_success,
    count(*) FILTER (WHERE {TASK_OK}) AS n_task_ok,
    count(DISTINCT node_id) FILTER (WHERE {NODE_OK}) AS n_node_ok,
    count(DISTINCT node_id) FILTER (WHERE {NODE_OK} AND {CANON}) AS n_node_canon,
    max(CASE WHEN {CANON} THEN TRY_CAST(substr(node_id, 2) AS BIGINT) END)
      FILTER (WHERE {NODE_OK}) AS max_node_idx
  FROM {src} GROUP BY workflow_id),
{p}gv AS (
  SELECT *, n_wf_success = 1 AS is_successful, n_task_ok = n_node_ok AS parity,
    (n_wf_success = 1 AND n_task_ok = n_node_ok) AS complete,
    CASE WHEN n_wf_success = 0 THEN 'no_success_event'
         WHEN n_wf_success > 1 THEN 'multiple_success_events'
         WHEN n_task_ok <> n_node_ok THEN 'task_node_mismatch'
         WHEN n_events <= 7 THEN 'too_few_events'
         ELSE 'complete' END AS reason,
    (n_wf_success = 1 AND n_task_ok = n_node_ok AND n_events > 7) AS accepted
  FROM {p}g),
{p}gb AS (
  SELECT *,
    CASE WHEN NOT accepted THEN NULL
         WHEN n_task_ok = 0 THEN 'no_tasks'
         WHEN NOT (n_node_canon = n_task_ok AND coalesce(max_node_idx, -1) = n_task_ok - 1)
           THEN 'missing_node'
         ELSE 'ok' END AS build
  FROM {p}gv),
{p}gx AS (SELECT *, coalesce(build = 'ok', FALSE) AS built FROM {p}gb)"""


GATE_CTE = gate_cte()

_TIME_ORDER = ("occurred_at_ns, arrival_seq, kind, phase, node_id NULLS FIRST, "
               "task_name NULLS FIRST, generated_name NULLS FIRST, wf_output_uri NULLS FIRST, "
               "task_version NULLS FIRST, input_uri NULLS FIRST, output_uri NULLS FIRST")


def _chain_cte(name: str, flag: str, src: str = "ev", gx: str = "gx") -> str:
    return f"""
{name} AS (
  SELECT e.*, {gx}.n_task_ok, row_number() OVER w - 1 AS task_index,
    lag(e.task_name) OVER w AS upstream_task
  FROM {src} e JOIN {gx} USING (workflow_id)
  WHERE {gx}.{flag} AND e.kind = 'task' AND e.phase = 3
  WINDOW w AS (PARTITION BY e.workflow_id ORDER BY {_TIME_ORDER}))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = _with(EVENTS_CTE, GATE_CTE, _chain_cte("tc", "built"))
BASE_ACCEPTED = _with(EVENTS_CTE, GATE_CTE, _chain_cte("tca", "accepted"))

_COMPLETED = ("strftime(make_timestamp(occurred_at_ns // 1000), '%Y-%m-%d %H:%M:%S') || "
              "CASE WHEN (occurred_at_ns // 1000) % 1000000 = 0 THEN '' ELSE '.' || "
              "lpad(CAST((occurred_at_ns // 1000) % 1000000 AS VARCHAR), 6, '0') END")
_VERSION = ("CASE WHEN regexp_matches(task_version, '^\\s*[+-]?\\d+(_\\d+)*\\s*$') THEN "
            "coalesce(TRY_CAST(regexp_replace(task_version, '[\\s_]', '', 'g') AS BIGINT), 0) "
            "ELSE 0 END")

HEADER_CTE = """
ph AS (
  SELECT workflow_id,
    arg_max(task_domain, task_index) || '.' || arg_max(task_project, task_index) || '.'
      || regexp_extract(arg_max(task_name, task_index), '^(.*)\\.[^.]*$', 1) AS pipeline_name,
    split_part(arg_min(generated_name, task_index), '-', 1) AS pipeline_id,
    count(*) AS n_tasks
  FROM tc GROUP BY workflow_id)"""

SQL: dict[str, str] = {
    "events_unified": _with(EVENTS_CTE) + """
SELECT kind, project, domain, exec_name, workflow_id, phase, occurred_at_ns, arrival_seq,
  node_id, wf_output_uri, task_name, task_version, task_project, task_domain, generated_name,
  input_uri, output_uri, array_to_string(log_uris, '|') AS log_uris FROM ev""",

    "successful_tasks": _with(EVENTS_CTE) + f"""
SELECT workflow_id, count(*) AS n_task_ok, count(DISTINCT generated_name) AS n_distinct_tasks,
  min(occurred_at_ns) AS first_ns, max(occurred_at_ns) AS last_ns
FROM ev WHERE {TASK_OK} GROUP BY workflow_id""",

    "successful_nodes_last": _with(EVENTS_CTE) + f"""
SELECT workflow_id, node_id, count(*) AS n_events,
  max({{'s': arrival_seq, 'n': occurred_at_ns, 'p': phase}}).s AS last_arrival_seq,
  max({{'s': arrival_seq, 'n': occurred_at_ns, 'p': phase}}).n AS last_ns
FROM ev WHERE {NODE_OK} GROUP BY workflow_id, node_id""",

    "workflow_success": _with(EVENTS_CTE) + f"""
SELECT workflow_id, count(*) FILTER (WHERE {WF_OK}) AS n_success_events,
  (count(*) FILTER (WHERE {WF_OK})) = 1 AS is_successful
FROM ev GROUP BY workflow_id""",

    "parity_gate": _with(EVENTS_CTE, GATE_CTE) + """
SELECT workflow_id, n_events, n_wf_success, n_task_ok, n_node_ok, is_successful, parity, complete
FROM gv""",

    "gate_outcome": _with(EVENTS_CTE, GATE_CTE) + """
SELECT workflow_id, reason, accepted, coalesce(build, '') AS build FROM gx""",

    "complete_events": _with(EVENTS_CTE, GATE_CTE) + f"""
SELECT workflow_id,
  row_number() OVER (PARTITION BY workflow_id ORDER BY {_TIME_ORDER}) - 1 AS event_pos,
  kind, phase, occurred_at_ns, arrival_seq, node_id, task_name
FROM ev JOIN gx USING (workflow_id) WHERE gx.accepted""",

    "event_order": _with(EVENTS_CTE) + f"""
SELECT workflow_id,
  row_number() OVER (PARTITION BY workflow_id ORDER BY {_TIME_ORDER}) - 1 AS event_pos,
  kind, phase, occurred_at_ns, arrival_seq, node_id
FROM ev""",

    "task_chain": BASE + """
SELECT workflow_id, task_index, task_name, generated_name, upstream_task, occurred_at_ns FROM tc""",

    "node_pairing": BASE_ACCEPTED + f""",
nd AS (SELECT DISTINCT workflow_id, node_id FROM ev WHERE {NODE_OK})
SELECT t.workflow_id, t.task_index, 'n' || CAST(t.task_index AS VARCHAR) AS node_id,
  nd.node_id IS NOT NULL AS paired
FROM tca t LEFT JOIN nd ON t.workflow_id = nd.workflow_id
  AND nd.node_id = 'n' || CAST(t.task_index AS VARCHAR)""",

    "pairing_rejects": _with(EVENTS_CTE, GATE_CTE) + """
SELECT workflow_id, build AS reason, n_task_ok, n_node_ok FROM gx WHERE accepted AND NOT built""",

    "task_projection": BASE + f"""
SELECT workflow_id, task_index, generated_name AS task_id, task_name,
  coalesce(log_uris[1], '') AS url, {_VERSION} AS version,
  coalesce(input_uri, '') AS input_uri_args, coalesce(output_uri, '') AS output_uri_args,
  {_COMPLETED} AS completed, coalesce(task_version, '') AS version_text
FROM tc""",

    "pipeline_header": BASE + "," + HEADER_CTE + """
SELECT workflow_id, pipeline_name, pipeline_id, n_tasks FROM ph""",

    "pipeline_tasks": BASE + "," + HEADER_CTE + """
SELECT tc.workflow_id, pipeline_name, pipeline_id, n_tasks, task_index, task_name
FROM tc JOIN ph ON tc.workflow_id = ph.workflow_id""",
}


# --- literals and datasets ------------------------------------------------------

# The driver tables in TESTDATA.md order and their columns with the
# Arrow-style type names Spark's parquet read gives (FIXTURES.md §4).
TABLE_SCHEMAS = {
    "region": [("r_regionkey", "int32"), ("r_name", "string")],
    "nation": [("n_nationkey", "int32"), ("n_name", "string"), ("n_regionkey", "int32")],
    "customer": [("c_custkey", "int64"), ("c_name", "string"), ("c_nationkey", "int32"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "int64"), ("s_name", "string"), ("s_nationkey", "int32"),
                 ("s_acctbal", "double")],
    "part": [("p_partkey", "int64"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "int32"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "int64"), ("o_custkey", "int64"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp[us]"),
               ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "int64"), ("l_partkey", "int64"), ("l_suppkey", "int64"),
                 ("l_linenumber", "int32"), ("l_quantity", "double"),
                 ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                 ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp[us]")],
    "events": [("event_id", "int64"), ("ts", "timestamp[us]"), ("user_id", "int64"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "int64"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "int64")],
    "embeddings": [("vec_id", "int64"), ("embedding", "list<element: float>"),
                   ("label", "int32")],
    "pages": [("page_id", "int64"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "int64"), ("text", "string")],
    "labels": [("doc_id", "int64"), ("quality", "int32"), ("toxic", "int32")],
    "conversations": [("conv_id", "int64"), ("turn", "int64"), ("role", "string"),
                      ("text", "string")],
}
_WIDTHS = {"int8": 1, "int16": 2, "int32": 4, "int64": 8, "float": 4, "double": 8,
           "date32[day]": 4, "timestamp[us]": 8, "duration[us]": 8}
_TABLE_LIST = "[" + ", ".join(f"'{t}'" for t in TABLE_SCHEMAS) + "]"


def _table_uri(idx: str) -> str:
    return f"'dataset://' || {_TABLE_LIST}[({idx}) % 14 + 1]"


LIT_CTE = f"""
lb AS (
  SELECT CAST(l_partkey AS BIGINT) AS part, CAST(l_suppkey AS BIGINT) AS supp,
    's3://meta/o' || CAST(l_orderkey AS VARCHAR) || '/n' || CAST(l_linenumber - 1 AS VARCHAR)
      AS node_dir
  FROM lineitem),
lit AS (
  SELECT node_dir || '/outputs.pb' AS uri, 'o0' AS var, 'schema' AS kind,
    {_table_uri('part')} AS schema_uri FROM lb WHERE part % 5 <> 0 AND part % 3 >= 1
  UNION ALL SELECT node_dir || '/outputs.pb', 'o1', 'blob', CAST(NULL AS VARCHAR)
    FROM lb WHERE part % 5 <> 0 AND part % 3 = 2
  UNION ALL SELECT node_dir || '/outputs.pb', 'o2', 'schema', {_table_uri('part + 7')}
    FROM lb WHERE part % 5 <> 0 AND part % 3 = 2
  UNION ALL SELECT node_dir || '/outputs.pb', 'o3', 'collection', CAST(NULL AS VARCHAR)
    FROM lb WHERE part % 5 <> 0 AND part % 3 = 2
  UNION ALL SELECT node_dir || '/inputs.pb', 'i0', 'schema', {_table_uri('supp')}
    FROM lb WHERE supp % 2 = 1),
sl AS (
  SELECT uri, schema_uri, row_number() OVER (PARTITION BY uri ORDER BY var, schema_uri NULLS FIRST) - 1 AS ordinal
  FROM lit WHERE kind = 'schema')"""

TD_CTE = f"""
want AS (
  SELECT workflow_id, task_index, task_name, task_version, occurred_at_ns, n_task_ok,
    'o' AS direction, output_uri AS map_uri FROM tc WHERE output_uri IS NOT NULL
  UNION ALL
  SELECT workflow_id, task_index, task_name, task_version, occurred_at_ns, n_task_ok,
    'i' AS direction, coalesce(input_uri, '') AS map_uri FROM tc WHERE task_index = 0),
td AS (
  SELECT w.workflow_id, w.task_index, w.task_name, w.direction, sl.ordinal,
    w.task_name || '.' || w.direction || CAST(sl.ordinal AS VARCHAR) AS dataset_name,
    sl.schema_uri, sl.schema_uri || '/00000' AS dataset_uri,
    {_VERSION.replace('task_version', 'w.task_version')} AS version,
    w.occurred_at_ns AS created_ns, w.n_task_ok,
    CASE WHEN w.direction = 'i' THEN -1 ELSE w.task_index END AS slot
  FROM want w JOIN sl ON w.map_uri = sl.uri)"""

DS_BASE = BASE + "," + LIT_CTE + "," + TD_CTE


def _nbytes_sql(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for name, typ in cols:
        p = (f"(CASE WHEN count({name}) < count(*) THEN CAST(ceil(count(*) / 8.0) AS BIGINT) "
             "ELSE 0 END)")
        if typ == "bool":
            p += " + CAST(ceil(count(*) / 8.0) AS BIGINT)"
        elif typ in _WIDTHS:
            p += f" + count(*) * {_WIDTHS[typ]}"
        elif typ in ("string", "binary"):
            p += f" + 4 * count(*) + coalesce(sum(strlen({name})), 0)"
        elif typ.startswith("list<element: "):
            w = _WIDTHS[typ[len("list<element: "):-1]]
            p += f" + 4 * count(*) + {w} * coalesce(sum(len({name})), 0)"
        parts.append(p)
    return (f"SELECT '{table}' AS dataset, count(*) AS n_rows, {len(cols)} AS n_cols, "
            f"CAST({' + '.join(parts)} AS BIGINT) AS nbytes FROM {table}")


PROFILE_CTE = "prof AS (" + "\nUNION ALL ".join(
    _nbytes_sql(t, cols) for t, cols in TABLE_SCHEMAS.items()) + ")"


def _fields_values(schemas: dict) -> str:
    rows = []
    for ds, cols in schemas.items():
        for pos, (name, typ) in enumerate(cols):
            rows.append(f"('{ds}', {pos}, '{name}', '{typ}', TRUE)")
    return ("fields(dataset, position, name, native_type, nullable) AS (VALUES "
            + ", ".join(rows) + ")")


# The reference's type table (28 keys) plus decimal(20,0) (widened uint64).
_TYPE_MAP_ROWS = [
    ("None", "Null"), ("null", "Null"), ("bool", "Boolean"),
    ("int8", "Number"), ("int16", "Number"), ("int32", "Number"), ("int64", "Number"),
    ("uint8", "Number"), ("uint16", "Number"), ("uint32", "Number"), ("uint64", "Number"),
    ("halffloat", "Number"), ("float", "Number"), ("double", "Number"), ("string", "String"),
    ("time32[s]", "Time"), ("time64[us]", "Time"), ("timestamp[s]", "Time"),
    ("timestamp[ms]", "Time"), ("timestamp[us]", "Time"), ("timestamp[ns]", "Time"),
    ("duration[s]", "Time"), ("duration[ms]", "Time"), ("duration[us]", "Time"),
    ("duration[ns]", "Time"), ("date32[day]", "Date"), ("date64[ms]", "Date"),
    ("binary", "Bytes"), ("decimal128(20, 0)", "Number"),
]
CONVERT_CTE = (_fields_values(TABLE_SCHEMAS) + ",\n"
               + "tmap(t, cls) AS (VALUES "
               + ", ".join(f"('{a}', '{b}')" for a, b in _TYPE_MAP_ROWS) + "),\n" + """
conv AS (
  SELECT f.dataset, f.position, f.name AS field_path, f.native_type,
    CASE WHEN starts_with(f.native_type, 'list') THEN 'Array'
         WHEN starts_with(f.native_type, 'dictionary') THEN 'Map'
         ELSE m.cls END AS type_class,
    f.name AS description, FALSE AS recursive, f.nullable
  FROM fields f LEFT JOIN tmap m ON f.native_type = m.t),
dsok AS (
  SELECT dataset, bool_and(type_class IS NOT NULL) AS ok,
    count(*) FILTER (WHERE type_class IS NULL) AS n_bad_fields,
    arg_min(field_path, position) FILTER (WHERE type_class IS NULL) AS first_bad
  FROM conv GROUP BY dataset)""")

SQL.update({
    "dataset_literals": _with(LIT_CTE) + """
SELECT uri, var, kind, schema_uri,
  CASE WHEN kind = 'schema' THEN row_number() OVER (PARTITION BY uri, kind = 'schema'
    ORDER BY var, schema_uri NULLS FIRST) - 1 END AS ordinal
FROM lit""",

    "datasets_per_map": _with(LIT_CTE) + """
SELECT uri, count(*) AS n_literals, count(*) FILTER (WHERE kind = 'schema') AS n_datasets
FROM lit GROUP BY uri""",

    "dataset_names": DS_BASE + """
SELECT workflow_id, task_index, direction, ordinal, dataset_name, dataset_uri FROM td""",

    "task_outputs": DS_BASE + """
SELECT workflow_id, task_index, task_name, ordinal, dataset_name FROM td WHERE direction = 'o'""",

    "task_inputs": DS_BASE + """
SELECT workflow_id, task_index, ordinal, dataset_name FROM td WHERE direction = 'i'
UNION ALL
SELECT workflow_id, task_index + 1 AS task_index, ordinal, dataset_name FROM td
WHERE direction = 'o' AND task_index + 1 < n_task_ok""",

    "run_datasets": DS_BASE + """
SELECT workflow_id, slot, ordinal, dataset_name, dataset_uri FROM td""",

    "dataset_profile": _with(PROFILE_CTE) + """
SELECT dataset, n_rows, n_cols, nbytes FROM prof""",

    "schema_fields": DS_BASE + "," + CONVERT_CTE + """
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, c.position, c.field_path,
  c.native_type, c.type_class, c.description, c.recursive, c.nullable
FROM td JOIN conv c ON td.schema_uri = 'dataset://' || c.dataset
  JOIN dsok d ON c.dataset = d.dataset WHERE d.ok""",

    "schema_rejects": DS_BASE + "," + CONVERT_CTE + """,
nodouble AS (
  SELECT dataset, count(*) AS n_bad_fields, arg_min(field_path, position) AS first_bad
  FROM conv WHERE type_class IS NULL OR native_type = 'double' GROUP BY dataset)
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, n.n_bad_fields, n.first_bad,
  'unable to convert field ''' || n.first_bad || '''' AS reason
FROM td JOIN nodouble n ON td.schema_uri = 'dataset://' || n.dataset""",

    "schema_hash": DS_BASE + "," + _fields_values(TABLE_SCHEMAS) + """,
ft AS (SELECT 'dataset://' || dataset AS uri, list_sort(list(native_type)) AS types
       FROM fields GROUP BY dataset)
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name,
  md5(td.dataset_name || array_to_string(ft.types, '')) AS schema_hash
FROM td JOIN ft ON td.schema_uri = ft.uri""",

    "schema_text": DS_BASE + "," + _fields_values(TABLE_SCHEMAS) + """,
raw AS (SELECT dataset, string_agg(name || ': ' || native_type
    || CASE WHEN nullable THEN '' ELSE ' not null' END, chr(10) ORDER BY position) AS schema_text
  FROM fields GROUP BY dataset)
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, r.schema_text
FROM td JOIN raw r ON td.schema_uri = 'dataset://' || r.dataset""",

    "dataset_metadata": DS_BASE + "," + PROFILE_CTE + """
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, td.version, td.created_ns,
  td.dataset_uri AS meta_uri,
  '(' || CAST(p.n_rows AS VARCHAR) || ', ' || CAST(p.n_cols AS VARCHAR) || ')' AS meta_shape,
  CAST(p.nbytes AS VARCHAR) AS meta_nbytes
FROM td JOIN prof p ON td.schema_uri = 'dataset://' || p.dataset""",
})


# --- entities ----------------------------------------------------------------------

_DS_URN = "'urn:li:dataset:(urn:li:dataPlatform:flyte,' || {} || ',DEV)'"
_FLOW_URN = "'urn:li:dataFlow:(flyte,' || {} || ',DEV)'"
_JOB_URN = "'urn:li:dataJob:(urn:li:dataFlow:(flyte,' || {} || ',DEV),' || {} || ')'"

ENT_BASE = DS_BASE + "," + HEADER_CTE + "," + PROFILE_CTE + "," + _fields_values(TABLE_SCHEMAS) + """,
ft AS (SELECT 'dataset://' || dataset AS uri, list_sort(list(native_type)) AS types,
         count(*) AS n_fields FROM fields GROUP BY dataset),
tin AS (
  SELECT workflow_id, task_index, ordinal, dataset_name FROM td WHERE direction = 'i'
  UNION ALL
  SELECT workflow_id, task_index + 1, ordinal, dataset_name FROM td
  WHERE direction = 'o' AND task_index + 1 < n_task_ok),
tio AS (
  SELECT t.workflow_id, t.task_index,
    coalesce((SELECT string_agg(""" + _DS_URN.format("i.dataset_name") + """, ',' ORDER BY i.ordinal)
              FROM tin i WHERE i.workflow_id = t.workflow_id AND i.task_index = t.task_index), '')
      AS inputs,
    coalesce((SELECT string_agg(""" + _DS_URN.format("x.dataset_name") + """, ',' ORDER BY x.ordinal)
              FROM td x WHERE x.direction = 'o' AND x.workflow_id = t.workflow_id
                AND x.task_index = t.task_index), '') AS outputs
  FROM tc t),
dent AS (
  SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name,
    """ + _DS_URN.format("td.dataset_name") + """ AS urn, 4 AS n_aspects,
    'datasetProperties,status,ownership,schemaMetadata' AS aspect_names,
    md5(td.dataset_name || array_to_string(ft.types, '')) AS schema_hash,
    td.created_ns // 1000000 AS created_ms, CAST(ft.n_fields AS INTEGER) AS n_fields,
    '(' || CAST(p.n_rows AS VARCHAR) || ', ' || CAST(p.n_cols AS VARCHAR) || ')' AS shape,
    td.version
  FROM td JOIN ft ON td.schema_uri = ft.uri JOIN prof p ON td.schema_uri = 'dataset://' || p.dataset),
tent AS (
  SELECT tc.workflow_id, tc.task_index, tc.task_name,
    """ + _JOB_URN.format("ph.pipeline_name", "tc.task_name") + """ AS urn, 3 AS n_aspects,
    'dataJobInfo,dataJobInputOutput,ownership' AS aspect_names,
    coalesce(tc.log_uris[1], '') AS external_url, tio.inputs, tio.outputs,
    CASE WHEN tc.upstream_task IS NULL THEN ''
      ELSE """ + _JOB_URN.format("ph.pipeline_name", "tc.upstream_task") + """ END AS upstream
  FROM tc JOIN ph ON tc.workflow_id = ph.workflow_id
  JOIN tio ON tc.workflow_id = tio.workflow_id AND tc.task_index = tio.task_index),
fent AS (
  SELECT workflow_id, pipeline_name, """ + _FLOW_URN.format("pipeline_name") + """ AS urn,
    3 AS n_aspects, 'dataFlowInfo,ownership,globalTags' AS aspect_names FROM ph)"""

_MCE = """
SELECT workflow_id, 0 AS grp, slot, ordinal AS item, 'dataset' AS entity_type, urn,
  n_aspects FROM dent
UNION ALL SELECT workflow_id, 1, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'dataFlow', urn, n_aspects
  FROM fent
UNION ALL SELECT workflow_id, 2, task_index, CAST(0 AS BIGINT), 'dataJob', urn, n_aspects
  FROM tent"""

SQL.update({
    "dataset_entities": ENT_BASE + "\nSELECT * FROM dent",
    "task_entities": ENT_BASE + "\nSELECT * FROM tent",
    "flow_entities": ENT_BASE + "\nSELECT * FROM fent",
    "mce_stream": ENT_BASE + _MCE,
    "mce_datasets_only": ENT_BASE + """
SELECT workflow_id, 0 AS grp, slot, ordinal AS item, 'dataset' AS entity_type, urn, n_aspects
FROM dent""",
    "mce_single_task": ENT_BASE + """
SELECT workflow_id, task_name, urn, n_aspects FROM tent WHERE task_index = 0""",
    "lineage_edges": ENT_BASE + """,
edges AS (
  SELECT t.workflow_id, """ + _DS_URN.format("i.dataset_name") + """ AS src_urn, t.urn AS dst_urn,
    'dataset_to_task' AS edge_type
  FROM tent t JOIN tin i ON t.workflow_id = i.workflow_id AND t.task_index = i.task_index
  UNION ALL
  SELECT t.workflow_id, t.urn, """ + _DS_URN.format("x.dataset_name") + """, 'task_to_dataset'
  FROM tent t JOIN td x ON x.direction = 'o' AND t.workflow_id = x.workflow_id
    AND t.task_index = x.task_index
  UNION ALL
  SELECT workflow_id, upstream, urn, 'task_to_task' FROM tent WHERE upstream <> '')
SELECT * FROM edges""",
    "urns": ENT_BASE + """
SELECT workflow_id, 'dataset' AS entity_type, dataset_name AS name,
  """ + _DS_URN.format("dataset_name") + """ AS urn FROM td
UNION ALL SELECT workflow_id, 'dataFlow', pipeline_name, """ + _FLOW_URN.format("pipeline_name") + """
  FROM ph
UNION ALL SELECT tc.workflow_id, 'dataJob', tc.task_name,
  """ + _JOB_URN.format("ph.pipeline_name", "tc.task_name") + """
  FROM tc JOIN ph ON tc.workflow_id = ph.workflow_id""",
    "audit_stamps": DS_BASE + """
SELECT workflow_id, task_index, direction, ordinal, created_ns,
  created_ns // 1000000 AS time_ms, 'urn:li:corpuser:flyte_executor' AS actor FROM td""",
})


# --- prefix replay (first epoch) ------------------------------------------------------

_ARRIVAL_ORDER = ("arrival_seq, kind, phase, occurred_at_ns, node_id NULLS FIRST, "
                  "task_name NULLS FIRST, generated_name NULLS FIRST, wf_output_uri NULLS FIRST, "
                  "task_version NULLS FIRST, input_uri NULLS FIRST, output_uri NULLS FIRST")

PREFIX_CTE = f"""
fs AS (
  SELECT *, CASE WHEN {NODE_OK} AND row_number() OVER (PARTITION BY workflow_id, node_id, {NODE_OK}
    ORDER BY {_ARRIVAL_ORDER}) = 1 THEN 1 ELSE 0 END AS first_seen
  FROM ev),
sc AS (
  SELECT *, row_number() OVER wa - 1 AS arrival_pos,
    sum(CASE WHEN {WF_OK} THEN 1 ELSE 0 END) OVER wr AS c_wf,
    sum(CASE WHEN {TASK_OK} THEN 1 ELSE 0 END) OVER wr AS c_task,
    sum(first_seen) OVER wr AS c_node
  FROM fs
  WINDOW wa AS (PARTITION BY workflow_id ORDER BY {_ARRIVAL_ORDER}),
         wr AS (PARTITION BY workflow_id ORDER BY {_ARRIVAL_ORDER}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cut AS (
  SELECT workflow_id, min(arrival_pos) AS cut_pos, arg_min(arrival_seq, arrival_pos) AS cut_seq
  FROM sc WHERE c_wf = 1 AND c_task = c_node GROUP BY workflow_id),
pe AS (SELECT sc.* FROM sc JOIN cut USING (workflow_id) WHERE sc.arrival_pos <= cut.cut_pos)"""

PREFIX_BASE = _with(EVENTS_CTE, PREFIX_CTE, gate_cte("pe", "p"), _chain_cte("ptc", "built", "pe", "pgx"))

SQL.update({
    "prefix_replay": PREFIX_BASE + """
SELECT cut.workflow_id, cut.cut_seq, cut.cut_pos + 1 AS n_emitted,
  cut.cut_pos + 1 > 7 AS accepted, coalesce(pgx.build, '') AS build, pgx.n_task_ok AS n_tasks
FROM cut JOIN pgx ON cut.workflow_id = pgx.workflow_id""",
    "prefix_tasks": PREFIX_BASE + """
SELECT workflow_id, task_index, task_name, upstream_task FROM ptc""",
})


# --- envelopes ----------------------------------------------------------------------------

SQL.update({
    # decode(encode(events)) must give the events back unchanged
    "envelope_decode": SQL["events_unified"],
    "envelope_rejects": """
SELECT 'envelope' AS stage, CAST(event_id AS VARCHAR) AS key,
  CASE WHEN event_type = 'error' THEN 'unknown_subject'
       WHEN event_type = 'purchase' THEN 'invalid_envelope'
       ELSE 'invalid_base64' END AS reason
FROM events
WHERE event_type = 'error' OR (event_type IN ('purchase', 'click') AND user_id % 5 = 0)""",
})

SQL.update({
    "stream_replay": _with(EVENTS_CTE, PREFIX_CTE) + """
SELECT workflow_id, cut_seq, cut_pos + 1 AS n_emitted, cut_pos + 1 > 7 AS accepted FROM cut""",
})


# --- sinks ---------------------------------------------------------------------------------

_DB = "'flyte_' || split_part(ph.pipeline_name, '.', 1) || '_' || split_part(ph.pipeline_name, '.', 2)"
NAMES_CTE = f"""
nm AS (
  SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, td.schema_uri, td.created_ns,
    {_DB} AS db, replace(td.dataset_name, '.', '_') AS table_name,
    'warehouse://lineage/' || {_DB} || '/' || td.dataset_name || '/' AS path
  FROM td JOIN ph ON td.workflow_id = ph.workflow_id)"""
SINK_BASE = DS_BASE + "," + HEADER_CTE + "," + NAMES_CTE

SQL.update({
    "catalog_names": SINK_BASE + """
SELECT workflow_id, slot, ordinal, dataset_name, db, table_name, path FROM nm""",
    "missing_databases": SINK_BASE + """
SELECT DISTINCT db FROM nm WHERE db <> 'default'""",
    "schema_history": SINK_BASE + "," + _fields_values(TABLE_SCHEMAS) + """,
ftx AS (
  SELECT 'dataset://' || dataset AS uri,
    string_agg(name || ':' || native_type || ':' || CAST(nullable AS VARCHAR), ','
               ORDER BY position) AS fields_text
  FROM fields GROUP BY dataset),
hw AS (
  SELECT nm.*, ftx.fields_text,
    lag(ftx.fields_text) OVER (PARTITION BY db, table_name
                               ORDER BY created_ns, workflow_id, slot, ordinal) AS prev_fields
  FROM nm JOIN ftx ON nm.schema_uri = ftx.uri)
SELECT db, table_name,
  row_number() OVER (PARTITION BY db, table_name ORDER BY created_ns, workflow_id, slot, ordinal)
    AS version,
  created_ns AS since_ns, fields_text
FROM hw WHERE prev_fields IS NULL OR prev_fields <> fields_text""",
    "catalog_write": SINK_BASE + "," + PROFILE_CTE + """,
win AS (
  SELECT db, table_name,
    arg_max(schema_uri, {'a': created_ns, 'b': workflow_id, 'c': slot, 'd': ordinal}) AS source
  FROM nm GROUP BY db, table_name)
SELECT db, table_name, source, status,
  CASE WHEN status = 'written' THEN n_rows ELSE 0 END AS n_rows
FROM (
  SELECT win.db, win.table_name, win.source, p.n_rows,
    -- the catalog accepts only letters, digits and _ in names; other writes fail and are logged
    CASE WHEN regexp_matches(win.db, '^[A-Za-z0-9_]+$')
      AND regexp_matches(win.table_name, '^[A-Za-z0-9_]+$') THEN 'written' ELSE 'failed' END
      AS status
  FROM win JOIN prof p ON win.source = 'dataset://' || p.dataset)""",
    "latest_entities": ENT_BASE + """,
rc AS (SELECT workflow_id, max(occurred_at_ns) AS run_completed_ns FROM ev GROUP BY workflow_id),
m AS (""" + _MCE + """)
SELECT urn, arg_max(entity_type, {'t': rc.run_completed_ns, 'w': m.workflow_id, 'g': grp,
                                  's': slot, 'i': item}) AS entity_type,
  arg_max(m.workflow_id, {'t': rc.run_completed_ns, 'w': m.workflow_id, 'g': grp, 's': slot,
                          'i': item}) AS workflow_id,
  arg_max(n_aspects, {'t': rc.run_completed_ns, 'w': m.workflow_id, 'g': grp, 's': slot,
                      'i': item}) AS n_aspects,
  count(*) AS n_versions
FROM m JOIN rc ON m.workflow_id = rc.workflow_id GROUP BY urn""",
})

SQL.update({
    "fanout_log": ENT_BASE + "," + NAMES_CTE + """,
win AS (
  SELECT db, table_name,
    arg_max(schema_uri, {'a': created_ns, 'b': workflow_id, 'c': slot, 'd': ordinal}) AS source
  FROM nm GROUP BY db, table_name)
SELECT 'metadata' AS target, urn AS key, 'emitted' AS status FROM (""" + _MCE + """)
UNION ALL
SELECT 'catalog', db || '.' || table_name,
  CASE WHEN regexp_matches(db, '^[A-Za-z0-9_]+$') AND regexp_matches(table_name, '^[A-Za-z0-9_]+$')
       THEN 'written' ELSE 'failed' END
FROM win""",
})

# Every epoch of a run: from the last cut on, the first place where the counts of
# the events since then agree. A node is new if its last place lies before the cut.
EPOCHS = "WITH RECURSIVE " + EVENTS_CTE.strip() + f""",
pe AS (
  SELECT *, CASE WHEN {WF_OK} THEN 1 ELSE 0 END AS wf, CASE WHEN {TASK_OK} THEN 1 ELSE 0 END AS task,
    CASE WHEN {NODE_OK} THEN 1 ELSE 0 END AS node,
    row_number() OVER (PARTITION BY workflow_id ORDER BY {_ARRIVAL_ORDER}) - 1 AS place
  FROM ev),
se AS (
  SELECT workflow_id, arrival_seq, place, wf, task, node,
    lag(place) OVER (PARTITION BY workflow_id, node_id, node ORDER BY place) AS last_place
  FROM pe),
ep(workflow_id, epoch, start_place, cut_place, cut_seq) AS (
  SELECT DISTINCT workflow_id, 0, CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT) FROM se
  UNION ALL
  SELECT workflow_id, epoch + 1, cut_place, min(place), arg_min(arrival_seq, place)
  FROM (
    SELECT p.workflow_id, p.epoch, p.cut_place, s.place, s.arrival_seq,
      sum(s.wf) OVER w AS c_wf, sum(s.task) OVER w AS c_task,
      sum(CASE WHEN s.node = 1 AND coalesce(s.last_place, -1) <= p.cut_place THEN 1 ELSE 0 END) OVER w AS c_node
    FROM ep p JOIN se s ON s.workflow_id = p.workflow_id AND s.place > p.cut_place
    WINDOW w AS (PARTITION BY p.workflow_id ORDER BY s.place))
  WHERE c_wf = 1 AND c_task = c_node
  GROUP BY workflow_id, epoch, cut_place)
SELECT workflow_id, epoch, cut_seq, cut_place - start_place AS n_emitted,
  cut_place - start_place > 7 AS accepted
FROM ep WHERE epoch > 0"""
SQL.update({"prefix_epochs": EPOCHS, "stream_epochs": EPOCHS})


# --- aspect bodies --------------------------------------------------------------------

_PROJECT, _DOMAIN = "split_part({0}.workflow_id, '-', 1)", "split_part({0}.workflow_id, '-', 2)"
_ODD = "CAST(right({0}.workflow_id, 1) AS INTEGER) % 2 = 1"


def _owners_json(t: str, kind: str = "DATAOWNER") -> str:
    one = "'{{\"owner\":\"urn:li:corpuser:' || {} || '\",\"type\":\"" + kind + "\"}}'"
    return ("'{\"owners\":[' || " + one.format(_PROJECT.format(t)) + " || ',' || "
            + one.format(_DOMAIN.format(t) + " || '_team'")
            + " || '],\"lastModified\":{\"time\":0,\"actor\":\"urn:li:corpuser:unknown\"}}'")


def _tags_json(t: str) -> str:
    one = "'{{\"tag\":\"urn:li:tag:' || {} || '\"}}'"
    return ("CASE WHEN " + _ODD.format(t) + " THEN '{\"tags\":[' || " + one.format(_DOMAIN.format(t)) + " || ',' || "
            + one.format(_PROJECT.format(t)) + " || ']}' ELSE '{\"tags\":[]}' END")


def _numbered(keys: str, *parts: str) -> str:
    """The aspects of one entity a row each, numbered in order; parts are (aspect, place, json, condition)."""
    return "\nUNION ALL ".join(parts).join((f"SELECT {keys}, urn, CAST(row_number() OVER (PARTITION BY {keys}, urn "
                                            "ORDER BY o) - 1 AS INTEGER) AS place, aspect, json FROM (", ") x"))


_FIELD_JSON = ("'{\"fieldPath\":\"' || f.name || '\",\"nativeDataType\":\"' || f.native_type || "
               "'\",\"type\":{\"type\":{\"class\":\"' || v.type_class || '\"}},\"description\":\"' || f.name || "
               "'\",\"recursive\":false,\"nullable\":' || CAST(f.nullable AS VARCHAR) || '}'")
_UNSET = "{\"time\":0,\"actor\":\"urn:li:corpuser:unknown\"}"

DATASET_BODIES = DS_BASE + "," + PROFILE_CTE + "," + CONVERT_CTE + """,
sm AS (
  SELECT f.dataset, string_agg(""" + _FIELD_JSON + """, ',' ORDER BY f.position) AS fields_json,
    string_agg(f.name || ': ' || f.native_type, '\\n' ORDER BY f.position) AS raw,
    array_to_string(list_sort(list(f.native_type)), '') AS types
  FROM fields f JOIN conv v ON f.dataset = v.dataset AND f.position = v.position
    JOIN dsok d ON f.dataset = d.dataset WHERE d.ok GROUP BY f.dataset),
d AS (
  SELECT td.*, """ + _DS_URN.format("td.dataset_name") + """ AS urn, p.n_rows, p.n_cols, p.nbytes, sm.fields_json,
    sm.raw, md5(td.dataset_name || sm.types) AS hash
  FROM td JOIN prof p ON td.schema_uri = 'dataset://' || p.dataset JOIN sm ON sm.dataset = p.dataset)
""" + _numbered(
    "workflow_id, slot, ordinal",
    """SELECT *, 0 AS o, 'datasetProperties' AS aspect, '{"description":"","customProperties":{"uri":"' || dataset_uri
    || '","shape":"(' || n_rows || ', ' || n_cols || ')","nbytes":"' || nbytes || '"}}' AS json FROM d""",
    """SELECT *, 1, 'status', '{"removed":false}' FROM d""",
    "SELECT *, 2, 'ownership', " + _owners_json("d") + " FROM d",
    "SELECT *, 3, 'globalTags', " + _tags_json("d") + " FROM d WHERE " + _ODD.format("d"),
    """SELECT *, 4, 'schemaMetadata', '{"schemaName":"' || dataset_name
    || '","platform":"urn:li:dataPlatform:flyte","version":' || version || ',"hash":"' || hash
    || '","platformSchema":{"rawSchema":"' || raw || '"},"fields":[' || fields_json
    || '],"created":{"time":' || created_ns // 1000000 || ',"actor":"urn:li:corpuser:flyte_executor"},"lastModified":"""
    + _UNSET + "}' FROM d")


def _urn_list(column: str) -> str:
    return ("CASE WHEN " + column + " = '' THEN '[]' ELSE '[\"' || replace(" + column
            + ", ',urn:li:', '\",\"urn:li:') || '\"]' END")


TASK_BODIES = ENT_BASE + """,
t AS (
  SELECT tent.*, tc.input_uri, tc.output_uri, tc.task_version, """ + _COMPLETED.replace(
    "occurred_at_ns", "tc.occurred_at_ns") + """ AS completed
  FROM tent JOIN tc ON tent.workflow_id = tc.workflow_id AND tent.task_index = tc.task_index)
""" + _numbered(
    "workflow_id, task_index",
    """SELECT *, 0 AS o, 'dataJobInfo' AS aspect, '{"name":"' || task_name
    || '","type":"COMMAND","description":"","customProperties":{"input_uri_args":"' || coalesce(input_uri, '')
    || '","output_uri_args":"' || coalesce(output_uri, '') || '","completed":"' || completed || '","version":"'
    || coalesce(task_version, '') || '"},"externalUrl":"' || external_url || '"}' AS json FROM t""",
    """SELECT *, 1, 'dataJobInputOutput', '{"inputDatasets":' || """ + _urn_list("inputs")
    + """ || ',"outputDatasets":' || """ + _urn_list("outputs")
    + """ || CASE WHEN upstream = '' THEN '' ELSE ',"inputDatajobs":["' || upstream || '"]' END || '}' FROM t""",
    "SELECT *, 2, 'globalTags', " + _tags_json("t") + " FROM t WHERE " + _ODD.format("t"),
    "SELECT *, 3, 'ownership', " + _owners_json("t", "PRODUCER") + " FROM t")

FLOW_BODIES = ENT_BASE + _numbered(
    "workflow_id",
    """SELECT *, 0 AS o, 'dataFlowInfo' AS aspect, '{"name":"' || pipeline_name
    || '","description":"","customProperties":{},"externalUrl":""}' AS json FROM fent""",
    "SELECT *, 1, 'ownership', " + _owners_json("fent") + " FROM fent",
    "SELECT *, 2, 'globalTags', " + _tags_json("fent") + " FROM fent")

SQL.update({
    "dataset_aspects": DATASET_BODIES,
    "task_aspects": TASK_BODIES,
    "flow_aspects": FLOW_BODIES,
    "platform_aspects": DS_BASE + """
SELECT workflow_id, slot, ordinal, dataset_name AS name,
  'urn:li:dataset:(urn:li:dataPlatform:airflow,' || dataset_name || ',PROD)' AS urn, 'shared' AS db,
  'warehouse://lineage/shared/' || dataset_name || '/' AS path, 'urn:li:corpuser:airflow_executor' AS actor
FROM td""",
    "missing_databases": SINK_BASE + """
SELECT DISTINCT db FROM nm WHERE db NOT IN (
  SELECT db FROM nm WHERE CAST(right(workflow_id, 1) AS INTEGER) % 2 = 0 AND length(db) % 2 = 1)""",
})


# --- streaming lineage: the change events of every accepted epoch, its run key carrying the epoch -----------------

SQL["stream_lineage"] = EPOCHS[:EPOCHS.rindex("\nSELECT workflow_id, epoch")] + """,
sev AS (
  SELECT pe.* REPLACE (pe.workflow_id || '#' || CAST(ep.epoch AS VARCHAR) AS workflow_id)
  FROM pe JOIN ep ON pe.workflow_id = ep.workflow_id AND pe.place > ep.start_place AND pe.place <= ep.cut_place
  WHERE ep.epoch > 0 AND ep.cut_place - ep.start_place > 7),""" + gate_cte("sev", "s") + "," + _chain_cte(
    "tc", "built", "sev", "sgx") + ENT_BASE[len(BASE):] + _MCE


# --- footers, first parts, the latest table ------------------------------------------------------

def _footer_sql(table: str, cols: list[tuple[str, str]]) -> str:
    flat = [f"(count(*) - count({n}))" for n, t in cols if not t.startswith("list<")]
    text = "chr(10) || ".join(f"'{n}: {t}' || " for n, t in cols).rstrip("| ")
    return (f"SELECT 'dataset://{table}' AS schema_uri, count(*) AS n_rows, CAST({len(cols)} AS INTEGER) AS n_cols, "
            f"CAST({' + '.join(flat)} AS BIGINT) AS n_nulls, {text} AS schema_text FROM {table}")


SQL.update({
    "dataset_footers": "\nUNION ALL ".join(_footer_sql(t, cols) for t, cols in TABLE_SCHEMAS.items()),
    "first_part_datasets": DS_BASE + "," + _fields_values(TABLE_SCHEMAS) + """,
ft AS (SELECT 'dataset://' || dataset AS uri, list_sort(list(native_type)) AS types,
         CAST(count(*) AS INTEGER) AS n_cols FROM fields GROUP BY dataset)
SELECT td.workflow_id, td.slot, td.ordinal, td.dataset_name, ft.n_cols,
  md5(td.dataset_name || array_to_string(ft.types, '')) AS schema_hash
FROM td JOIN ft ON td.schema_uri = ft.uri""",
    "latest_merged": SQL["latest_entities"],
})


# --- expiry: what is left of a run behind its last cut, if its last event is long before the log's -----------------

SQL["stream_expired"] = EPOCHS[:EPOCHS.rindex("\nSELECT workflow_id, epoch")] + """,
done AS (SELECT workflow_id, max(epoch) AS epoch, max(cut_place) AS cut_place FROM ep GROUP BY workflow_id)
SELECT pe.workflow_id, CAST(done.epoch + 1 AS BIGINT) AS epoch, min(pe.arrival_seq) AS start_seq,
  count(*) AS n_emitted
FROM pe JOIN done ON pe.workflow_id = done.workflow_id AND pe.place > done.cut_place
GROUP BY pe.workflow_id, done.epoch
HAVING max(pe.occurred_at_ns) < (SELECT max(occurred_at_ns) FROM ev) - 100000000000000000"""
