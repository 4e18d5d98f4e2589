"""Lineage entities: dataset, task (job) and pipeline (flow) snapshots, edges.

A snapshot is a URN plus its ordered aspects, each aspect a JSON document
built by ``to_json(struct(...))`` (JVM-side). The change-event stream keeps
the reference's order through a sort key (group, slot, item) instead of a
position: datasets first, then the flow, then tasks in chain order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions.columns import (
    c, dataset_urn, flow_urn, job_urn, ns_to_millis, tag_urn, user_urn)
from eventweave.operators.profile import merge_metadata, schema_hash, shape_text
from eventweave.options import DEFAULT, LineageOptions

# Aspect names and the job type of the metadata model.
DATASET_ASPECTS = ("datasetProperties", "status", "ownership", "globalTags", "schemaMetadata")
JOB_ASPECTS = ("dataJobInfo", "dataJobInputOutput", "globalTags", "ownership")
FLOW_ASPECTS = ("dataFlowInfo", "ownership", "globalTags")
JOB_TYPE = "COMMAND"
OWNER_TYPE = "DATAOWNER"
UNSET_STAMP = (0, "urn:li:corpuser:unknown")     # time and actor of a stamp that nobody set


def _aspect(name: str, body: Column) -> Column:
    return F.struct(F.lit(name).alias("aspect"), F.to_json(body).alias("json"))


def unset_stamp() -> Column:
    return F.struct(F.lit(UNSET_STAMP[0]).cast("bigint").alias("time"), F.lit(UNSET_STAMP[1]).alias("actor"))


def owners_aspect(owners: Column, ownership_type: str | None = None) -> Column:
    """``urn:li:corpuser:{x}`` owners of one type (DATAOWNER), with the stamp of an unset change."""
    kind = ownership_type or OWNER_TYPE
    return F.struct(F.transform(owners, lambda x: F.struct(
        user_urn(x).alias("owner"), F.lit(kind).alias("type"))).alias("owners"), unset_stamp().alias("lastModified"))


def tags_aspect(tags: Column) -> Column:
    """``urn:li:tag:{x}`` associations."""
    return F.struct(F.transform(tags, lambda x: F.struct(tag_urn(x).alias("tag"))).alias("tags"))


def audit_stamp(ns: Column, o: LineageOptions = DEFAULT) -> Column:
    """Epoch ms (UTC) + ``urn:li:corpuser:{platform}_executor``; NULL when no time."""
    return F.when(ns.isNotNull(), F.struct(
        ns_to_millis(ns).alias("time"),
        F.lit(f"urn:li:corpuser:{o.platform}_executor").alias("actor")))


def _empty() -> Column:
    return F.array().cast("array<string>")


def _opt(df: DataFrame, name: str, default: Column) -> Column:
    """A column that callers may supply, else its default."""
    return F.coalesce(c(name), default) if name in df.columns else default


def dataset_entities(instances: DataFrame, converted: DataFrame, o: LineageOptions = DEFAULT,
                     owner_type: str | None = None) -> DataFrame:
    """L1: one snapshot per dataset instance whose schema converts.

    ``instances``: run dataset rows joined to their source profile (fields,
    n_rows, n_cols, nbytes, raw_schema). ``converted``: the fields of source
    datasets whose every field maps to a class (C3); each field of the change
    event carries its class.
    """
    classes = converted.groupBy(c("dataset").alias("schema_uri")).agg(     # a source's fields
        F.transform(F.array_sort(F.collect_list(F.struct("position", "type_class"))),
                    lambda x: x["type_class"]).alias("_classes"))
    d = instances.join(classes, "schema_uri")
    owners, tags = _opt(d, "owners", _empty()), _opt(d, "tags", _empty())
    meta = (c("metadata") if "metadata" in d.columns
            else F.create_map(F.lit("uri"), c("dataset_uri")))
    custom = merge_metadata(meta, c("n_rows"), c("n_cols"), c("nbytes"))
    fields = F.zip_with("fields", "_classes", lambda f, k: F.struct(
        f["name"].alias("fieldPath"), f["type"].alias("nativeDataType"),
        F.struct(F.struct(k.alias("class")).alias("type")).alias("type"),
        f["name"].alias("description"), F.lit(False).alias("recursive"),
        f["nullable"].alias("nullable")))
    schema_md = F.struct(
        c("dataset_name").alias("schemaName"),
        F.lit(f"urn:li:dataPlatform:{o.platform}").alias("platform"),
        c("version").alias("version"),
        schema_hash(c("dataset_name"), c("fields")).alias("hash"),
        F.struct(c("raw_schema").alias("rawSchema")).alias("platformSchema"),
        fields.alias("fields"),
        F.coalesce(audit_stamp(c("created_ns"), o), unset_stamp()).alias("created"),
        F.coalesce(audit_stamp(_opt(d, "last_modified_ns", F.lit(None).cast("bigint")), o),
                   unset_stamp()).alias("lastModified"))
    aspects = F.filter(F.array(
        _aspect("datasetProperties", F.struct(_opt(d, "description", F.lit("")).alias("description"),
                                              custom.alias("customProperties"))),
        _aspect("status", F.struct(F.lit(False).alias("removed"))),
        _aspect("ownership", owners_aspect(owners, owner_type)),
        F.when(F.size(tags) > 0, _aspect("globalTags", tags_aspect(tags))),
        _aspect("schemaMetadata", schema_md),
    ), lambda a: a.isNotNull())
    return d.select(
        "workflow_id", "slot", "ordinal", "dataset_name",
        F.lit("dataset").alias("entity_type"),
        dataset_urn(c("dataset_name"), o).alias("urn"),
        aspects.alias("aspects"),
        schema_hash(c("dataset_name"), c("fields")).alias("schema_hash"),
        ns_to_millis(c("created_ns")).alias("created_ms"),
        F.size(c("fields")).alias("n_fields"),
        shape_text(c("n_rows"), c("n_cols")).alias("shape"),
        "version")


def task_io(inputs: DataFrame, outputs: DataFrame, o: LineageOptions = DEFAULT) -> DataFrame:
    """Per task: ordered input and output dataset URN lists.

    A task's lists hold the variables of one literal map, so the collect is
    per task and bounded by that map, never by the run.
    """
    def urns(df, name):
        return df.groupBy("workflow_id", "task_index").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "dataset_name"))),
                        lambda s: dataset_urn(s["dataset_name"], o)).alias(name))
    return urns(inputs, "input_urns").join(urns(outputs, "output_urns"),
                                           ["workflow_id", "task_index"], "full")


def task_links(tasks: DataFrame, header: DataFrame, io: DataFrame,
               o: LineageOptions = DEFAULT) -> DataFrame:
    """Per chained task: its job URN and its input, output and upstream URN lists."""
    t = (tasks.join(header.select("workflow_id", "pipeline_name"), "workflow_id")
         .join(io, ["workflow_id", "task_index"], "left"))
    flow = c("pipeline_name")
    own = [x for x in ("description", "owners", "tags") if x in tasks.columns]
    return t.select(
        "workflow_id", "task_index", "task_name", "pipeline_name", "metadata", "url", *own,
        job_urn(flow, c("task_name"), o).alias("urn"),
        F.coalesce(c("input_urns"), _empty()).alias("input_urns"),
        F.coalesce(c("output_urns"), _empty()).alias("output_urns"),
        F.when(c("upstream_task").isNotNull(),
               F.array(job_urn(flow, c("upstream_task"), o))).alias("upstream_urns"))


def task_entities(links: DataFrame, o: LineageOptions = DEFAULT, owner_type: str | None = None) -> DataFrame:
    """L2: one snapshot per chained task: info, input/output, tags if any, owners.

    ``links`` may carry ``description``, ``owners`` and ``tags`` of the task.
    """
    tags = _opt(links, "tags", _empty())
    info = F.struct(c("task_name").alias("name"),
                    F.lit(JOB_TYPE).alias("type"), _opt(links, "description", F.lit("")).alias("description"),
                    c("metadata").alias("customProperties"), c("url").alias("externalUrl"))
    job_io = F.struct(c("input_urns").alias("inputDatasets"),
                      c("output_urns").alias("outputDatasets"),
                      c("upstream_urns").alias("inputDatajobs"))
    aspects = F.filter(F.array(
        _aspect("dataJobInfo", info), _aspect("dataJobInputOutput", job_io),
        F.when(F.size(tags) > 0, _aspect("globalTags", tags_aspect(tags))),
        _aspect("ownership", owners_aspect(_opt(links, "owners", _empty()), owner_type))), lambda a: a.isNotNull())
    return links.select(
        "workflow_id", "task_index", "task_name",
        F.lit("dataJob").alias("entity_type"), "urn", aspects.alias("aspects"),
        c("url").alias("external_url"), "input_urns", "output_urns", "upstream_urns")


def flow_entities(header: DataFrame, o: LineageOptions = DEFAULT, owner_type: str | None = None) -> DataFrame:
    """L3: one snapshot per pipeline: info, owners, tags (always three).

    ``header`` may carry ``description``, ``metadata``, ``url``, ``owners`` and ``tags``.
    """
    info = F.struct(c("pipeline_name").alias("name"), _opt(header, "description", F.lit("")).alias("description"),
                    _opt(header, "metadata", F.create_map().cast("map<string,string>")).alias("customProperties"),
                    _opt(header, "url", F.lit("")).alias("externalUrl"))
    aspects = F.array(_aspect("dataFlowInfo", info),
                      _aspect("ownership", owners_aspect(_opt(header, "owners", _empty()), owner_type)),
                      _aspect("globalTags", tags_aspect(_opt(header, "tags", _empty()))))
    return header.select("workflow_id", "pipeline_name", F.lit("dataFlow").alias("entity_type"),
                         flow_urn(c("pipeline_name"), o).alias("urn"), aspects.alias("aspects"))


def single_task(tasks: DataFrame, chosen: DataFrame) -> DataFrame:
    """The change events of chosen tasks only; ``chosen(workflow_id, task_name)``."""
    return tasks.join(chosen.select("workflow_id", "task_name").distinct(), ["workflow_id", "task_name"], "left_semi")


def mce_stream(datasets: DataFrame, flows: DataFrame, tasks: DataFrame,
               o: LineageOptions = DEFAULT) -> DataFrame:
    """Change events in emission order (grp, slot, item) per run."""
    cols = ["workflow_id", "grp", "slot", "item", "entity_type", "urn", "aspects"]
    parts = []
    if o.emit:
        parts.append(datasets.select("workflow_id", F.lit(0).alias("grp"), "slot",
                                     c("ordinal").alias("item"), "entity_type", "urn", "aspects"))
        if not o.datasets_only:
            parts.append(flows.select("workflow_id", F.lit(1).alias("grp"),
                                      F.lit(0).cast("bigint").alias("slot"),
                                      F.lit(0).cast("bigint").alias("item"),
                                      "entity_type", "urn", "aspects"))
            parts.append(tasks.select("workflow_id", F.lit(2).alias("grp"),
                                      c("task_index").alias("slot"),
                                      F.lit(0).cast("bigint").alias("item"),
                                      "entity_type", "urn", "aspects"))
    out = None
    for p in parts:
        p = p.select(*cols)
        out = p if out is None else out.unionByName(p)
    return out


def lineage_edges(links: DataFrame) -> DataFrame:
    """Dataset->task, task->dataset and task->task edges, one explode per task."""
    def edges(arr, kind, into_task):
        return F.transform(arr, lambda x: F.struct(
            (x if into_task else c("urn")).alias("src_urn"),
            (c("urn") if into_task else x).alias("dst_urn"),
            F.lit(kind).alias("edge_type")))
    all_edges = F.concat(edges(c("input_urns"), "dataset_to_task", True),
                         edges(c("output_urns"), "task_to_dataset", False),
                         edges(F.coalesce(c("upstream_urns"), _empty()), "task_to_task", True))
    return links.select("workflow_id", F.inline(all_edges))
