"""Named queries: (spark, sf_dir) -> DataFrame, flat scalar columns.

Each builds its plan from the driver tables through the adapter, so the
work grows with the tables. Column names equal those of ``oracle.SQL``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions.columns import (
    c, dataset_urn, flow_urn, is_node_ok, is_task_ok, is_wf_success, job_urn)
from eventweave.operators import chain as ch
from eventweave.operators import convert as cv
from eventweave.operators import datasets as ds
from eventweave.operators import gate as gt
from eventweave.operators import profile as pf
from eventweave.operators import replay as rp
from eventweave.operators import entities as en
from eventweave.operators.entities import audit_stamp
from eventweave.options import DEFAULT, LineageOptions
from eventweave.plans import lineage as ln
from eventweave.session import CODEC, checkpoint_dir, land
from eventweave.sinks import catalog as cat
from eventweave.sinks import targets as tg
from eventweave.sources import adapter
from eventweave.sources import envelope as envl
from eventweave.sources.tables import TABLES, read_table, table_path
from eventweave.streaming import gate_stream as gs
from eventweave.streaming import lineage_stream as ls

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf):
    return adapter.exec_events(spark, sf)


def events_unified(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    return ev.withColumn("log_uris", F.array_join("log_uris", "|"))


def successful_tasks(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf).filter(is_task_ok(o))
    return ev.groupBy("workflow_id").agg(
        F.count(F.lit(1)).alias("n_task_ok"),
        F.count_distinct("generated_name").alias("n_distinct_tasks"),
        F.min("occurred_at_ns").alias("first_ns"),
        F.max("occurred_at_ns").alias("last_ns"))


def successful_nodes_last(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf).filter(is_node_ok(o))
    last = F.max(F.struct("arrival_seq", "occurred_at_ns", "phase"))
    return ev.groupBy("workflow_id", "node_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        last["arrival_seq"].alias("last_arrival_seq"),
        last["occurred_at_ns"].alias("last_ns"))


def workflow_success(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    return ev.groupBy("workflow_id").agg(
        F.count_if(is_wf_success(o)).alias("n_success_events")
    ).withColumn("is_successful", c("n_success_events") == 1)


def _verdict(spark, sf, o):
    return gt.gate(_events(spark, sf), o)


def _gate_ck(ev, o):
    """Run verdicts written once to the checkpoint folder (one row per run): the
    chain reads them twice (hot-run check, join), the events only once."""
    return land(gt.gate(ev, o))


def parity_gate(spark, sf, o: LineageOptions = DEFAULT):
    v = _verdict(spark, sf, o)
    return v.select("workflow_id", "n_events", "n_wf_success", "n_task_ok", "n_node_ok",
                    "is_successful", "parity", "complete")


def gate_outcome(spark, sf, o: LineageOptions = DEFAULT):
    v = _verdict(spark, sf, o)
    return v.select("workflow_id", "reason", "accepted",
                    F.coalesce(c("build"), F.lit("")).alias("build"))


def complete_events(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    columns = ["kind", "phase", "occurred_at_ns", "arrival_seq", "node_id", "task_name"]
    pos = ch.event_positions(ev, _gate_ck(ev, o), "accepted", o, columns)
    return pos.select("workflow_id", "event_pos", *columns)


def event_order(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    columns = ["kind", "phase", "occurred_at_ns", "arrival_seq", "node_id"]
    pos = ch.event_positions(ev, land(gt.run_stats(ev, o)), None, o, columns)
    return pos.select("workflow_id", "event_pos", *columns)


def task_chain(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    chain = ch.task_chain(ev, _gate_ck(ev, o), o)
    return chain.select("workflow_id", "task_index", "task_name", "generated_name",
                        "upstream_task", "occurred_at_ns")


def node_pairing(spark, sf, o: LineageOptions = DEFAULT):
    """J1 for every gate-accepted run: does task i find node n{i}?"""
    ev = _events(spark, sf)
    v = _gate_ck(ev, o)
    chain = ch.task_chain(ev, v, o, column="accepted")
    nodes = (gt.keep_events(ev.filter(is_node_ok(o)), v, "accepted")
             .select("workflow_id", "node_id").distinct()
             .withColumn("paired", F.lit(True)))
    want = chain.select("workflow_id", "task_index",
                        F.concat(F.lit("n"), c("task_index").cast("string")).alias("node_id"))
    return (want.join(nodes, ["workflow_id", "node_id"], "left")
            .select("workflow_id", "task_index", "node_id",
                    F.coalesce(c("paired"), F.lit(False)).alias("paired")))


def pairing_rejects(spark, sf, o: LineageOptions = DEFAULT):
    v = _verdict(spark, sf, o)
    return v.filter(c("accepted") & ~c("built")).select(
        "workflow_id", c("build").alias("reason"), "n_task_ok", "n_node_ok")


def task_projection(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    return ch.task_projection(ch.task_chain(ev, _gate_ck(ev, o), o))


def pipeline_header(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    return ch.pipeline_header(ch.task_chain(ev, _gate_ck(ev, o), o))


def pipeline_tasks(spark, sf, o: LineageOptions = DEFAULT):
    ev = _events(spark, sf)
    chain = land(ch.task_chain(ev, _gate_ck(ev, o), o))
    head = ch.pipeline_header(chain)
    return chain.join(head, "workflow_id").select(
        "workflow_id", "pipeline_name", "pipeline_id", "n_tasks", "task_index", "task_name")


QUERIES: dict[str, Query] = {
    "events_unified": events_unified,
    "successful_tasks": successful_tasks,
    "successful_nodes_last": successful_nodes_last,
    "workflow_success": workflow_success,
    "parity_gate": parity_gate,
    "gate_outcome": gate_outcome,
    "complete_events": complete_events,
    "event_order": event_order,
    "task_chain": task_chain,
    "node_pairing": node_pairing,
    "pairing_rejects": pairing_rejects,
    "task_projection": task_projection,
    "pipeline_header": pipeline_header,
    "pipeline_tasks": pipeline_tasks,
}


# --- datasets ------------------------------------------------------------------


def _chain(spark, sf, o):
    ev = _events(spark, sf)
    return ch.task_chain(ev, _gate_ck(ev, o), o)


def _task_datasets(spark, sf, o):
    chain = land(_chain(spark, sf, o))
    return ds.task_datasets(chain, ds.chain_literals(adapter.literals(spark, sf), chain), o)


def dataset_literals(spark, sf, o: LineageOptions = DEFAULT):
    return ds.literal_ordinals(adapter.literals(spark, sf))


def datasets_per_map(spark, sf, o: LineageOptions = DEFAULT):
    return ds.datasets_per_map(adapter.literals(spark, sf))


def dataset_names(spark, sf, o: LineageOptions = DEFAULT):
    return _task_datasets(spark, sf, o).select(
        "workflow_id", "task_index", "direction", "ordinal", "dataset_name", "dataset_uri")


def task_outputs(spark, sf, o: LineageOptions = DEFAULT):
    return ds.task_outputs(_task_datasets(spark, sf, o))


def task_inputs(spark, sf, o: LineageOptions = DEFAULT):
    return ds.task_inputs(_task_datasets(spark, sf, o))


def run_datasets(spark, sf, o: LineageOptions = DEFAULT):
    return ds.run_datasets(_task_datasets(spark, sf, o)).select(
        "workflow_id", "slot", "ordinal", "dataset_name", "dataset_uri")


def table_frames(spark, sf) -> dict:
    return {t: (read_table(spark, sf, t), adapter.DATASET_SCHEME + t) for t in TABLES}


def _profiles(spark, sf):
    return pf.profile_many(spark, table_frames(spark, sf))


def dataset_profile(spark, sf, o: LineageOptions = DEFAULT):
    return _profiles(spark, sf).select("dataset", "n_rows", "n_cols", "nbytes")


def _footers(spark, sf, o):
    return ln.profile_sources(spark, {adapter.DATASET_SCHEME + t: table_path(sf, t) for t in TABLES}, o)


def dataset_footers(spark, sf, o: LineageOptions = DEFAULT):
    """Rows, columns, nulls and schema of every source from its footers, no data read."""
    return _footers(spark, sf, o).select(c("uri").alias("schema_uri"), "n_rows", "n_cols", "n_nulls",
                                         c("raw_schema").alias("schema_text"))


def first_part_datasets(spark, sf, o: LineageOptions = DEFAULT):
    """S8 with the one-part-file scan: schema of the dataset instances of the built runs from first parts."""
    prof = _footers(spark, sf, replace(o, first_part_only=True))
    return _run_datasets(spark, sf, o).join(prof.select(c("uri").alias("dataset"), "n_cols", "fields"), "dataset").select(
        "workflow_id", "slot", "ordinal", "dataset_name", "n_cols",
        pf.schema_hash(c("dataset_name"), c("fields")).alias("schema_hash"))


def _source_fields(spark, sf):
    """The columns of every source that a literal can point at, by its URI."""
    tz = spark.conf.get("spark.sql.session.timeZone", "UTC")
    return cv.fields_frame(spark, {uri: pf.schema_fields(df.schema, tz)
                                   for df, uri in table_frames(spark, sf).values()})


def _run_datasets(spark, sf, o):
    return ds.run_datasets(_task_datasets(spark, sf, o)).select(
        "workflow_id", "slot", "ordinal", "dataset_name", c("schema_uri").alias("dataset"))


def schema_fields(spark, sf, o: LineageOptions = DEFAULT):
    """The converted fields of every dataset instance of the built runs."""
    conv = cv.CatalogSchemaConverter(spark, strict=o.strict_types).convert(_source_fields(spark, sf))
    good, _ = cv.all_or_nothing(conv)
    return _run_datasets(spark, sf, o).join(good, "dataset").drop("dataset")


def schema_rejects(spark, sf, o: LineageOptions = DEFAULT):
    """Instances that a type table without doubles rejects, each as a whole."""
    own = cv.type_map_frame(spark).filter(c("native_type") != "double")
    conv = cv.CatalogSchemaConverter(spark, own, strict=o.strict_types).convert(_source_fields(spark, sf))
    _, bad = cv.all_or_nothing(conv)
    return _run_datasets(spark, sf, o).join(bad, "dataset").drop("dataset")


def _instances(spark, sf, o):
    """Dataset instances of built runs joined to their source profiles."""
    inst = ds.run_datasets(_task_datasets(spark, sf, o))
    prof = _profiles(spark, sf)
    return inst.join(prof, inst.schema_uri == prof.uri).drop("uri")


def schema_hash(spark, sf, o: LineageOptions = DEFAULT):
    inst = _instances(spark, sf, o)
    return inst.select("workflow_id", "slot", "ordinal", "dataset_name",
                       pf.schema_hash(c("dataset_name"), c("fields")).alias("schema_hash"))


def schema_text(spark, sf, o: LineageOptions = DEFAULT):
    """The schema text of every dataset instance's source."""
    return _instances(spark, sf, o).select(
        "workflow_id", "slot", "ordinal", "dataset_name", c("raw_schema").alias("schema_text"))


def dataset_metadata(spark, sf, o: LineageOptions = DEFAULT):
    """Custom properties of each dataset instance (uri, shape, nbytes)."""
    inst = _instances(spark, sf, o)
    return inst.select(
        "workflow_id", "slot", "ordinal", "dataset_name", "version", "created_ns",
        c("dataset_uri").alias("meta_uri"),
        pf.shape_text(c("n_rows"), c("n_cols")).alias("meta_shape"),
        c("nbytes").cast("string").alias("meta_nbytes"))


QUERIES.update({
    "dataset_literals": dataset_literals,
    "datasets_per_map": datasets_per_map,
    "dataset_names": dataset_names,
    "task_outputs": task_outputs,
    "task_inputs": task_inputs,
    "run_datasets": run_datasets,
    "dataset_profile": dataset_profile,
    "dataset_footers": dataset_footers,
    "first_part_datasets": first_part_datasets,
    "schema_fields": schema_fields,
    "schema_rejects": schema_rejects,
    "schema_hash": schema_hash,
    "schema_text": schema_text,
    "dataset_metadata": dataset_metadata,
})


# --- entities, change events, edges ------------------------------------------------


def _lineage(spark, sf, o, profiles: bool = True, datasets: bool = True):
    """All frames; ``profiles``, ``datasets``: whether the caller reads the datasets' profiles, and the tasks'
    datasets, which are then landed."""
    return ln.build(spark, _events(spark, sf), adapter.literals(spark, sf),
                    _profiles(spark, sf), o, materialize=True, land_profiles=profiles, land_datasets=datasets)


def _names(col):
    return F.array_join(F.transform(col, lambda a: a["aspect"]), ",")


def dataset_entities(spark, sf, o: LineageOptions = DEFAULT):
    d = _lineage(spark, sf, o).dataset_entities
    return d.select("workflow_id", "slot", "ordinal", "dataset_name", "urn",
                    F.size("aspects").alias("n_aspects"), _names(c("aspects")).alias("aspect_names"),
                    "schema_hash", "created_ms", "n_fields", "shape", "version")


def task_entities(spark, sf, o: LineageOptions = DEFAULT):
    t = _lineage(spark, sf, o, profiles=False).task_entities
    return t.select("workflow_id", "task_index", "task_name", "urn",
                    F.size("aspects").alias("n_aspects"), _names(c("aspects")).alias("aspect_names"),
                    "external_url",
                    F.array_join("input_urns", ",").alias("inputs"),
                    F.array_join("output_urns", ",").alias("outputs"),
                    F.coalesce(F.array_join("upstream_urns", ","), F.lit("")).alias("upstream"))


def flow_entities(spark, sf, o: LineageOptions = DEFAULT):
    f = _lineage(spark, sf, o, profiles=False, datasets=False).flow_entities
    return f.select("workflow_id", "pipeline_name", "urn", F.size("aspects").alias("n_aspects"),
                    _names(c("aspects")).alias("aspect_names"))


def _people(df):
    """Owners and tags derived from the run's key: its project owns, its domain tags every other order."""
    part = F.split("workflow_id", "-")
    odd = F.substring("workflow_id", -1, 1).cast("int") % 2 == 1
    return (df.withColumn("owners", F.array(part[0], F.concat(part[1], F.lit("_team"))))
            .withColumn("tags", F.when(odd, F.array(part[1], part[0])).otherwise(F.array().cast("array<string>"))))


def _bodies(entities, *keys):
    """One row per aspect of each entity, with its JSON text."""
    return entities.select(*keys, "urn", F.posexplode("aspects").alias("place", "a")).select(
        *keys, "urn", "place", c("a.aspect").alias("aspect"), c("a.json").alias("json"))


def dataset_aspects(spark, sf, o: LineageOptions = DEFAULT):
    """The aspects of every dataset instance, with owners, and tags where there are some."""
    lf = _lineage(spark, sf, o)
    instances = _people(lf.datasets.join(lf.profiles.withColumnRenamed("uri", "schema_uri"), "schema_uri"))
    ent = en.dataset_entities(instances, lf.fields, o)
    return _bodies(ent, "workflow_id", "slot", "ordinal")


def task_aspects(spark, sf, o: LineageOptions = DEFAULT):
    """The aspects of every task, its owners of a type of their own."""
    lf = _lineage(spark, sf, o, profiles=False)
    links = en.task_links(_people(lf.tasks), lf.header, en.task_io(lf.inputs, lf.outputs, o), o)
    return _bodies(en.task_entities(links, o, "PRODUCER"), "workflow_id", "task_index")


def flow_aspects(spark, sf, o: LineageOptions = DEFAULT):
    """The aspects of every pipeline."""
    header = _lineage(spark, sf, o, profiles=False, datasets=False).header
    return _bodies(en.flow_entities(_people(header), o), "workflow_id")


def platform_aspects(spark, sf, o: LineageOptions = DEFAULT):
    """Change events under another platform, environment and database."""
    o = replace(o, platform="airflow", env="PROD", db_name="shared")
    names = _catalog_names(spark, sf, o).select("workflow_id", "slot", "ordinal", c("dataset_name").alias("name"),
                                               dataset_urn(c("dataset_name"), o).alias("urn"), "db", "path")
    stamps = audit_stamp(F.lit(0).cast("bigint"), o)["actor"]
    return names.withColumn("actor", stamps)


def _mce_flat(m):
    return m.select("workflow_id", "grp", "slot", "item", "entity_type", "urn",
                    F.size("aspects").alias("n_aspects"))


def mce_stream(spark, sf, o: LineageOptions = DEFAULT):
    return _mce_flat(_lineage(spark, sf, o).mce)


def mce_datasets_only(spark, sf, o: LineageOptions = DEFAULT):
    return _mce_flat(_lineage(spark, sf, replace(o, datasets_only=True)).mce)


def mce_single_task(spark, sf, o: LineageOptions = DEFAULT):
    """The change event of one chosen task (the first task of each pipeline)."""
    lf = _lineage(spark, sf, o, profiles=False)
    t = en.single_task(lf.task_entities, lf.chain.filter(c("task_index") == 0).select("workflow_id", "task_name"))
    return t.select("workflow_id", "task_name", "urn", F.size("aspects").alias("n_aspects"))


def lineage_edges(spark, sf, o: LineageOptions = DEFAULT):
    return _lineage(spark, sf, o, profiles=False).edges


def urns(spark, sf, o: LineageOptions = DEFAULT):
    """URNs of every dataset instance, pipeline and task."""
    lf = _lineage(spark, sf, o, profiles=False)
    d = lf.datasets.select("workflow_id", F.lit("dataset").alias("entity_type"),
                           c("dataset_name").alias("name"),
                           dataset_urn(c("dataset_name"), o).alias("urn"))
    f = lf.header.select("workflow_id", F.lit("dataFlow").alias("entity_type"),
                         c("pipeline_name").alias("name"), flow_urn(c("pipeline_name"), o).alias("urn"))
    t = lf.chain.join(lf.header, "workflow_id").select(
        "workflow_id", F.lit("dataJob").alias("entity_type"), c("task_name").alias("name"),
        job_urn(c("pipeline_name"), c("task_name"), o).alias("urn"))
    return d.unionByName(f).unionByName(t)


def audit_stamps(spark, sf, o: LineageOptions = DEFAULT):
    """Created audit stamp of each dataset instance."""
    d = _task_datasets(spark, sf, o)
    st = audit_stamp(c("created_ns"), o)
    return d.select("workflow_id", "task_index", "direction", "ordinal", "created_ns",
                    st["time"].alias("time_ms"), st["actor"].alias("actor"))


QUERIES.update({
    "dataset_entities": dataset_entities,
    "task_entities": task_entities,
    "flow_entities": flow_entities,
    "dataset_aspects": dataset_aspects,
    "task_aspects": task_aspects,
    "flow_aspects": flow_aspects,
    "platform_aspects": platform_aspects,
    "mce_stream": mce_stream,
    "mce_datasets_only": mce_datasets_only,
    "mce_single_task": mce_single_task,
    "lineage_edges": lineage_edges,
    "urns": urns,
    "audit_stamps": audit_stamps,
})


# --- prefix replay ---------------------------------------------------------------------


def prefix_replay(spark, sf, o: LineageOptions = DEFAULT):
    """First completion of each run in arrival order, and what it builds (from the counts at the cut)."""
    checkpoint_dir(spark)
    return rp.cut_verdicts(rp.first_cuts(_events(spark, sf), o), o).select(
        "workflow_id", "cut_seq", "n_emitted", "accepted",
        F.coalesce(c("build"), F.lit("")).alias("build"), c("n_task_ok").alias("n_tasks"))


def prefix_tasks(spark, sf, o: LineageOptions = DEFAULT):
    checkpoint_dir(spark)
    emitted, cuts = rp.prefix_events(_events(spark, sf), o)
    chain = ch.task_chain(emitted, rp.cut_verdicts(cuts, o).checkpoint(), o)
    return chain.select("workflow_id", "task_index", "task_name", "upstream_task")


def prefix_epochs(spark, sf, o: LineageOptions = DEFAULT):
    """Every epoch's cut (events after a cut start a new accumulation)."""
    checkpoint_dir(spark)
    return rp.prefix_epochs(_events(spark, sf), o).select(
        "workflow_id", "epoch", "cut_seq", "n_emitted", "accepted")


QUERIES.update({
    "prefix_replay": prefix_replay,
    "prefix_tasks": prefix_tasks,
    "prefix_epochs": prefix_epochs,
})


# --- envelopes ------------------------------------------------------------------------


def _junk(spark, sf):
    return envl.junk(read_table(spark, sf, "events", "event_id", "event_type", "user_id", "props"))


def envelopes(spark, sf):
    """The envelope log: every adapter event encoded, plus bad messages from ``events``."""
    return envl.encode(_events(spark, sf)).unionByName(_junk(spark, sf))


def _landed_envelopes(spark, sf):
    """The envelope log as landed data: encoded once, written to the checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/envelopes-{uuid.uuid4().hex}"
    log = envelopes(spark, sf)
    log.write.parquet(path, compression=CODEC)
    return spark.read.schema(log.schema).parquet(path)


def envelope_decode(spark, sf, o: LineageOptions = DEFAULT):
    ev, _ = envl.decode(_landed_envelopes(spark, sf))
    return ev.withColumn("log_uris", F.array_join("log_uris", "|"))


def envelope_rejects(spark, sf, o: LineageOptions = DEFAULT):
    _, bad = envl.decode(_landed_envelopes(spark, sf))
    return bad.select("stage", "key", "reason")


QUERIES.update({
    "envelope_decode": envelope_decode,
    "envelope_rejects": envelope_rejects,
})


# --- streaming ------------------------------------------------------------------------

def _land_log(spark, sf, root):
    """The rows of ``envelopes`` as a log in arrival order, encoded once they are in it."""
    bad = _junk(spark, sf).select("arrival_seq", c("body").alias("bad_body"), F.lit(True).alias("bad"))
    rows = _events(spark, sf).unionByName(bad, allowMissingColumns=True)

    def encode(ranged):
        return envl.encode(ranged, "bad", "bad_body", "range").select(
            F.when(c("bad"), c("bad_body")).otherwise(c("body")).alias("body"), "arrival_seq", "range")
    gs.land_envelopes(rows, root, encode=encode)


def _stream_cuts(spark, sf, o):
    landing = f"{checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"
    _land_log(spark, sf, landing)
    cuts, _ = gs.replay_stream(spark, landing, o, files_per_trigger=4)
    return cuts


def stream_replay(spark, sf, o: LineageOptions = DEFAULT):
    """First completion of each run from the streaming gate (= prefix replay)."""
    cuts = _stream_cuts(spark, sf, o)
    return cuts.filter((c("epoch") == 1) & (c("status") == "complete")).select(
        "workflow_id", "cut_seq", "n_emitted", "accepted")


def stream_epochs(spark, sf, o: LineageOptions = DEFAULT):
    """Every epoch's cut from the streaming gate (= prefix_epochs)."""
    return _stream_cuts(spark, sf, o).filter(c("status") == "complete").select(
        "workflow_id", "epoch", "cut_seq", "n_emitted", "accepted")


EXPIRE_MS = 100_000_000_000


def stream_expired(spark, sf, o: LineageOptions = DEFAULT):
    """T4: open runs given up, once the whole log has passed their last event by about three years."""
    landing = f"{checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"
    _land_log(spark, sf, landing)
    cuts, _ = gs.replay_stream(spark, landing, o, files_per_trigger=1_000_000, expire_after_ms=EXPIRE_MS)
    return cuts.filter(c("status") == "expired").select("workflow_id", "epoch", "start_seq", "n_emitted")


QUERIES.update({
    "stream_expired": stream_expired,
    "stream_replay": stream_replay,
    "stream_epochs": stream_epochs,
})


# --- sinks ------------------------------------------------------------------------------


LOGICAL_BUCKET = "warehouse://lineage"


def _catalog_names(spark, sf, o, bucket=LOGICAL_BUCKET):
    chain = land(_chain(spark, sf, o))
    tdata = ds.task_datasets(chain, ds.chain_literals(adapter.literals(spark, sf), chain), o)
    return cat.catalog_names(ds.run_datasets(tdata), ch.pipeline_header(chain), bucket, o.db_name)


def catalog_names(spark, sf, o: LineageOptions = DEFAULT):
    """Database, table and path of every dataset instance."""
    return _catalog_names(spark, sf, o).select("workflow_id", "slot", "ordinal", "dataset_name", "db",
                                       "table_name", "path")


def missing_databases(spark, sf, o: LineageOptions = DEFAULT):
    """Databases that a catalog lacks which has those of the runs of even orders."""
    names = _catalog_names(spark, sf, o)
    held = names.where(F.substring("workflow_id", -1, 1).cast("int") % 2 == 0).select("db").distinct()
    odd_domains = held.where(F.length("db") % 2 == 1)
    return cat.missing_databases(spark, names, odd_domains)


def _fields_text(spark, sf):
    return _profiles(spark, sf).select(
        c("uri").alias("schema_uri"),
        F.array_join(F.transform("fields", lambda f: F.concat_ws(
            ":", f["name"], f["type"], f["nullable"].cast("string"))), ",").alias("fields_text"))


def schema_history(spark, sf, o: LineageOptions = DEFAULT):
    """K6: schema versions of each catalog table across all its writes."""
    return cat.schema_history(_catalog_names(spark, sf, o), _fields_text(spark, sf),
                              o.hot_group_rows)


def _resolver(spark, sf):
    def resolve(uri: str):
        return read_table(spark, sf, uri[len(adapter.DATASET_SCHEME):])
    return resolve


def catalog_write(spark, sf, o: LineageOptions = DEFAULT):
    """K2/K5/K7: write every catalog table, read the rows back."""
    bucket = f"{checkpoint_dir(spark)}/catalog-{uuid.uuid4().hex}"
    writes = cat.latest_writes(_catalog_names(spark, sf, o, bucket))
    log = cat.write_catalog(spark, writes, _resolver(spark, sf))
    return log.join(cat.read_back_counts(log), "path", "left").select(
        "db", "table_name", "source", "status",
        F.coalesce(c("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"))


def latest_entities(spark, sf, o: LineageOptions = DEFAULT):
    """K1: the change event that wins per URN after all runs are emitted."""
    return tg.latest_entities(_lineage(spark, sf, o).mce).select(
        "urn", "entity_type", "workflow_id", F.size("aspects").alias("n_aspects"), "n_versions")


def latest_merged(spark, sf, o: LineageOptions = DEFAULT):
    """K1 kept up to date: two batches of runs merged one after the other into the latest table."""
    root = f"{checkpoint_dir(spark)}/latest-{uuid.uuid4().hex}"
    mce = _lineage(spark, sf, o).mce
    odd = F.substring("workflow_id", -1, 1).cast("int") % 2
    for k in range(2):
        latest = tg.merge_latest(spark, root, mce.where(odd == k), f"b-{k:06d}")
    return latest.select("urn", "entity_type", "workflow_id", F.size("aspects").alias("n_aspects"), "n_versions")


def fanout_log(spark, sf, o: LineageOptions = DEFAULT):
    """Metadata then catalog target, each isolated; their write log."""
    root = f"{checkpoint_dir(spark)}/fanout-{uuid.uuid4().hex}"
    frames = _lineage(spark, sf, o)
    targets = [tg.MetadataTarget(f"{root}/mce", o),
               tg.CatalogTarget(spark, f"{root}/catalog", _resolver(spark, sf), o.db_name)]
    return tg.fanout(spark, frames, targets).select("target", "key", "status")


QUERIES.update({
    "catalog_names": catalog_names,
    "missing_databases": missing_databases,
    "schema_history": schema_history,
    "latest_entities": latest_entities,
    "latest_merged": latest_merged,
    "catalog_write": catalog_write,
    "fanout_log": fanout_log,
})


def stream_lineage(spark, sf, o: LineageOptions = DEFAULT):
    """T1-T6 + K8/K9 end to end: streaming gate -> per-batch lineage -> metadata target."""
    root = f"{checkpoint_dir(spark)}/stream-lineage-{uuid.uuid4().hex}"
    _land_log(spark, sf, f"{root}/landing")
    target = tg.MetadataTarget(f"{root}/mce", o)
    ls.run_lineage_stream(spark, f"{root}/landing", adapter.literals(spark, sf),
                          _profiles(spark, sf), [target], o, files_per_trigger=4)
    mce = spark.read.parquet(f"{root}/mce")
    return mce.select("workflow_id", "grp", "slot", "item", "entity_type", "urn",
                      F.size("aspects").alias("n_aspects"))


QUERIES["stream_lineage"] = stream_lineage
