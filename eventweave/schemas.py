"""Canonical schemas of the frames the library passes around."""

from __future__ import annotations

from pyspark.sql import types as T

# One wide row per execution event; `kind` says which variant it is.
EXEC_EVENTS = T.StructType([
    T.StructField("kind", T.StringType()),            # task | node | workflow
    T.StructField("project", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("exec_name", T.StringType()),
    T.StructField("workflow_id", T.StringType()),     # project-domain-name
    T.StructField("phase", T.IntegerType()),
    T.StructField("occurred_at_ns", T.LongType()),
    T.StructField("arrival_seq", T.LongType()),
    T.StructField("node_id", T.StringType()),         # node events
    T.StructField("wf_output_uri", T.StringType()),   # workflow events
    T.StructField("task_name", T.StringType()),       # task events from here on
    T.StructField("task_version", T.StringType()),
    T.StructField("task_project", T.StringType()),
    T.StructField("task_domain", T.StringType()),
    T.StructField("generated_name", T.StringType()),
    T.StructField("input_uri", T.StringType()),
    T.StructField("output_uri", T.StringType()),      # NULL when unset
    T.StructField("log_uris", T.ArrayType(T.StringType())),
])
EXEC_EVENT_COLUMNS = [f.name for f in EXEC_EVENTS.fields]

# One row per variable of a literal map stored at `uri`.
LITERALS = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("var", T.StringType()),
    T.StructField("kind", T.StringType()),            # schema | blob | collection
    T.StructField("schema_uri", T.StringType()),      # location of the dataset
])

FIELD = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),            # Arrow-style type name
    T.StructField("nullable", T.BooleanType()),
])

DATASET_PROFILE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("created_ns", T.LongType()),
    T.StructField("last_modified_ns", T.LongType()),
    T.StructField("version", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_cols", T.IntegerType()),
    T.StructField("nbytes", T.LongType()),
    T.StructField("owners", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fields", T.ArrayType(FIELD)),
    T.StructField("schema_hash", T.StringType()),
    T.StructField("uri", T.StringType()),
])

# Metadata change event: one entity snapshot with its ordered aspects.
MCE = T.StructType([
    T.StructField("entity_type", T.StringType()),     # dataset | dataFlow | dataJob
    T.StructField("urn", T.StringType()),
    T.StructField("aspects", T.ArrayType(T.StructType([
        T.StructField("aspect", T.StringType()),
        T.StructField("json", T.StringType()),
    ]))),
    T.StructField("ord", T.LongType()),
])

REJECTS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("payload", T.StringType()),
])
