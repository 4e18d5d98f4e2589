"""Literal maps -> named datasets of each task, input propagation, run datasets.

Everything stays flat (one row per dataset instance) so no run is ever
collected into one row: a task's inputs are the previous task's output rows
re-keyed to the next index, which needs no window and no self join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.functions.columns import c, version_number
from eventweave.options import DEFAULT, LineageOptions
from eventweave.session import land


def schema_literals(literals: DataFrame) -> DataFrame:
    """F4 + W5: schema literals only, with their 0-based ordinal in the map.

    The ordinal counts schema literals in variable-name order (the
    reference iterates a protobuf map, whose order is not fixed).
    A literal map holds a task's few variables, so the window per URI is small.
    """
    w = Window.partitionBy("uri").orderBy("var", F.col("schema_uri").asc_nulls_first())
    return (literals.filter(c("kind") == "schema")
            .withColumn("ordinal", (F.row_number().over(w) - 1).cast("bigint")))


def literal_ordinals(literals: DataFrame) -> DataFrame:
    """All literals with the schema ordinal (NULL for blobs and collections)."""
    w = Window.partitionBy("uri", (c("kind") == "schema").alias("_s")).orderBy(
        "var", F.col("schema_uri").asc_nulls_first())
    return literals.withColumn(
        "ordinal", F.when(c("kind") == "schema", (F.row_number().over(w) - 1).cast("bigint")))


def chain_literals(literals: DataFrame, chain: DataFrame) -> DataFrame:
    """The literals of the maps that the chain's tasks name, whole maps: what ``task_datasets`` looks up.

    The URIs are landed, so a set small enough is broadcast and the other maps are neither shuffled nor sorted.
    """
    named = F.array(F.when(c("task_index") == 0, F.coalesce(c("input_uri"), F.lit(""))), c("output_uri"))
    uris = land(chain.select(F.explode(named).alias("uri")).filter(c("uri").isNotNull()))
    return literals.join(uris, "uri", "left_semi")


def datasets_per_map(literals: DataFrame) -> DataFrame:
    """Variables and schema datasets found per literal map."""
    return literals.groupBy("uri").agg(
        F.count(F.lit(1)).alias("n_literals"),
        F.count_if(c("kind") == "schema").alias("n_datasets"))


def task_datasets(chain: DataFrame, literals: DataFrame, o: LineageOptions = DEFAULT) -> DataFrame:
    """Datasets read (first task) and written (every task).

    One row per dataset instance: direction 'i' or 'o', ordinal, name
    ``{task_name}.{i|o}{ordinal}``, the schema URI it points at, version and
    creation time from the task event. Output maps are looked up only when
    the output URI is set; the input map only for the first task.
    """
    lits = schema_literals(literals).select("uri", "ordinal", "schema_uri")
    base = chain.select("workflow_id", "task_index", "task_name", "task_version",
                        "occurred_at_ns", "n_task_ok", "input_uri", "output_uri")
    # both directions of a task from one pass over the chain
    wanted = (base.withColumn("direction", F.explode(F.array(F.lit("o"), F.lit("i"))))
              .filter(F.when(c("direction") == "o", c("output_uri").isNotNull()).otherwise(c("task_index") == 0))
              .withColumn("map_uri", F.when(c("direction") == "o", c("output_uri"))
                          .otherwise(F.coalesce(c("input_uri"), F.lit("")))))
    found = wanted.join(lits, wanted.map_uri == lits.uri).drop("uri")
    return found.select(
        "workflow_id", "task_index", "task_name", "direction", "ordinal",
        F.concat(c("task_name"), F.lit("."), c("direction"), c("ordinal").cast("string"))
        .alias("dataset_name"),
        "schema_uri",
        F.concat(c("schema_uri"), F.lit(o.part_file)).alias("dataset_uri"),
        version_number(c("task_version")).alias("version"),
        c("occurred_at_ns").alias("created_ns"),
        "n_task_ok",
    )


def task_inputs(datasets: DataFrame) -> DataFrame:
    """First task -> its own inputs; task i >= 1 -> outputs of task i-1."""
    own = datasets.filter(c("direction") == "i").select(
        "workflow_id", "task_index", "ordinal", "dataset_name")
    passed = (datasets.filter((c("direction") == "o") & (c("task_index") + 1 < c("n_task_ok")))
              .select("workflow_id", (c("task_index") + 1).alias("task_index"),
                      "ordinal", "dataset_name"))
    return own.unionByName(passed)


def task_outputs(datasets: DataFrame) -> DataFrame:
    return datasets.filter(c("direction") == "o").select(
        "workflow_id", "task_index", "task_name", "ordinal", "dataset_name")


def run_datasets(datasets: DataFrame) -> DataFrame:
    """The run's dataset list, order = (slot, ordinal); slot -1 = first inputs.

    Duplicates are kept; the order key replaces a list position so no
    per-run window or collect is needed.
    """
    slot = F.when(c("direction") == "i", F.lit(-1).cast("bigint")).otherwise(c("task_index"))
    return datasets.select("workflow_id", slot.alias("slot"), "ordinal", "dataset_name",
                           "dataset_uri", "schema_uri", "version", "created_ns")
