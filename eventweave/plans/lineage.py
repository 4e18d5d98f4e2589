"""End-to-end lineage plan: events + literal maps + dataset resolver -> frames.

``build`` only declares DataFrames; nothing runs until a sink or a caller
acts on one of them. Shared inputs (the run verdicts, the chain) are
declared once and referenced by several outputs; callers that act on many
outputs of the same build should persist ``chain`` (see ``sinks.fanout``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions.columns import c
from eventweave.operators import chain as ch
from eventweave.operators import convert as cv
from eventweave.operators import datasets as ds
from eventweave.operators import entities as en
from eventweave.operators import gate as gt
from eventweave.operators import profile as pf
from eventweave.options import DEFAULT, LineageOptions
from eventweave.session import land
from eventweave.sources import footers

@dataclass
class LineageFrames:
    verdict: DataFrame          # one row per run: counts, reason, accepted, built
    chain: DataFrame            # one row per task of a built run
    tasks: DataFrame            # Task records (projection + metadata map)
    header: DataFrame           # one row per pipeline
    datasets: DataFrame         # one row per dataset instance (run order key)
    inputs: DataFrame           # task inputs after propagation
    outputs: DataFrame          # task outputs
    profiles: DataFrame         # one row per source dataset
    fields: DataFrame           # converted fields of convertible sources
    schema_rejects: DataFrame   # sources with an unmappable column
    dataset_entities: DataFrame
    task_entities: DataFrame
    flow_entities: DataFrame
    mce: DataFrame              # change events in emission order
    edges: DataFrame            # lineage edges


def profile_sources(spark: SparkSession, sources: dict[str, str], o: LineageOptions = DEFAULT) -> DataFrame:
    """Profiles of source datasets (uri -> path) from their Parquet footers, whatever their number.

    With ``o.first_part_only`` the one part file that the reference reads
    stands for its dataset; empty datasets have no schema (``footer_profiles``).
    """
    rows = [(uri.rsplit("/", 1)[-1], uri, path) for uri, path in sources.items()]
    columns = footers.footers(spark, rows, o.part_file if o.first_part_only else None)
    return footers.footer_profiles(columns, empty_as_unknown=True)


def build(spark: SparkSession, events: DataFrame, literals: DataFrame,
          profiles: DataFrame, o: LineageOptions = DEFAULT,
          type_map: DataFrame | None = None, materialize: bool = False, land_profiles: bool | None = None,
          land_datasets: bool | None = None) -> LineageFrames:
    """Declare every lineage output.

    With ``materialize`` the chain is written once to the checkpoint folder,
    and with ``land_profiles`` and ``land_datasets`` (by default with
    ``materialize``) the profiles, one row per source, and the task datasets;
    the outputs that branch off read them there.

    ``profiles`` has one row per source dataset (``pf.profile`` columns with
    ``uri`` = the schema URI the literals point at).
    """
    # The run verdicts (one row per run) are read several times: written once
    # to the checkpoint folder.
    verdict = land(gt.gate(events, o))
    chain = ch.task_chain(events, verdict, o)
    if materialize:
        chain = land(chain)
    tasks = ch.task_metadata(ch.task_projection(chain)).join(
        chain.select("workflow_id", "task_index", "upstream_task"), ["workflow_id", "task_index"])
    header = ch.pipeline_header(chain)
    if materialize if land_datasets is None else land_datasets:
        tdata = land(ds.task_datasets(chain, ds.chain_literals(literals, chain), o))
    else:
        tdata = ds.task_datasets(chain, literals, o)
    if materialize if land_profiles is None else land_profiles:
        profiles = land(profiles)
    inputs = ds.task_inputs(tdata)
    outputs = ds.task_outputs(tdata)
    run_ds = ds.run_datasets(tdata)

    prof = profiles.withColumnRenamed("uri", "schema_uri")
    instances = run_ds.join(prof, "schema_uri")

    field_rows = prof.select(c("schema_uri").alias("dataset"),
                             F.posexplode("fields").alias("position", "f")).select(
        "dataset", c("position").cast("int"), c("f.name").alias("name"),
        c("f.type").alias("native_type"), c("f.nullable").alias("nullable"))
    conv = cv.CatalogSchemaConverter(spark, type_map, strict=o.strict_types).convert(field_rows)
    good, bad = cv.all_or_nothing(conv)

    d_ent = en.dataset_entities(instances, good, o)
    io = en.task_io(inputs, outputs, o)
    links = en.task_links(tasks, header, io, o)
    t_ent = en.task_entities(links, o)
    f_ent = en.flow_entities(header, o)
    mce = en.mce_stream(d_ent, f_ent, t_ent, o)
    if mce is not None:
        mce = mce.join(verdict.select("workflow_id", c("ns_max").alias("run_completed_ns")),
                       "workflow_id")
    edges = en.lineage_edges(links)
    return LineageFrames(verdict, chain, tasks, header, run_ds, inputs, outputs, profiles,
                         good, bad, d_ent, t_ent, f_ent, mce, edges)
