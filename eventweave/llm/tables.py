"""Landed tables, tolerant column access and connected components for the text operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyspark.cloudpickle as cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import eventweave


SMALL_KEYS = 2_000_000       # narrow rows that a join may send to every task, some 50 MB
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package() -> None:
    """Send this package's functions to the Python workers by value, so that
    executors need not have it installed."""
    cloudpickle.register_pickle_by_value(eventweave)


def arrow_schema(columns: str):
    """The Arrow schema of flat columns given as "name type, ..."; it needs no session."""
    import pyarrow as pa
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A folder of its own is made only for a local master without that setting
    (tests); on a cluster the setting is required.
    """
    ship_package()
    if spark.conf.get(BATCH_ROWS) == "10000":       # its default; whole texts are long rows
        spark.conf.set(BATCH_ROWS, "1000")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventweave-llm-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


_landed: list[str] = []


def land(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{label}-{uuid.uuid4().hex}"
    _landed.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark writes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def swept(spark: SparkSession):
    """Tables landed inside are deleted at the end, when nothing reads them any more."""
    before = len(_landed)
    try:
        yield
    finally:
        for path in _landed[before:]:
            remove(spark, path)
        del _landed[before:]


def keyed_join(rows: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """``rows`` joined with the narrow table ``keys`` by a column, whatever the size of either.

    ``keys`` is landed and counted. Up to ``SMALL_KEYS`` rows are sent to all
    tasks, so that the rows, whole texts, stay where they are; more go through
    a shuffle join.
    """
    keys = land(keys, "keys")
    small = keys.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS
    return rows.join(F.broadcast(keys) if small else keys.hint("merge"), on, how)


def discard(*tables: DataFrame) -> None:
    """Delete landed tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)``; component is the smallest node.

    Each round a node takes the least label among its own and its
    neighbours'; when any changed, labels are also followed to their own
    labels, so that chains shorten by halves. A round without changes ends
    it. Each round lands its labels; nothing of the graph reaches the driver.
    """
    both = land(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                .where("a <> b").distinct(), "graph")
    labels = land(both.groupBy(F.col("a").alias("node"))
                  .agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        told = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .select(F.col("a").alias("node"), "component", F.lit(None).cast("long").alias("own"))
                .union(labels.select("node", "component", F.col("component"))))
        step = land(told.groupBy("node").agg(F.min("component").alias("component"), F.max("own").alias("before")),
                    "labels")
        if not step.where("component <> before").limit(1).count():
            discard(both, labels)
            return step.select("node", "component")
        hop = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = land(step.join(hop, "component", "left")
                     .select("node", F.least("component", "next").alias("component")), "labels")
        discard(labels, step)
        labels = after


def give_back() -> None:
    """Return a worker's freed memory to the system at the end of a task, since workers live on between stages."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def tidy(fn):
    """``fn`` of one group's table, after which the worker's freed memory goes back to the system."""
    def run(table):
        try:
            return fn(table)
        finally:
            give_back()
    return run


def map_texts(df: DataFrame, key: str, text: str, fn, columns: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """``fn(keys, texts)`` over slices of about ``batch_bytes`` of text.

    ``fn`` gets the key values and the texts as lists (null texts as None) and
    returns one list or array per column of ``columns``, of any common length.
    Slices follow the rows of a partition, so memory does not depend on how
    many rows it has; one longer text is a slice of its own.
    """
    scratch_root(df.sparkSession)
    schema = arrow_schema(columns)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            part = (sizes.cumsum() - sizes) // batch_bytes
            cuts = [0, *(part[1:] != part[:-1]).nonzero()[0] + 1, len(part)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a < b:
                    rows = batch.slice(a, b - a)
                    out = fn(rows.column(0).to_pylist(), rows.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=f.type) for v, f in zip(out, schema)], schema=schema)
        give_back()

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, columns)
