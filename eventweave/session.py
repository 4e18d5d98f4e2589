"""SparkSession helpers.

The library never creates a cluster session on its own; jobs pass theirs in.
``local_session`` exists for tests, the bench and the driver smoke checks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-run state and windows sort by these; keep codegen on.
    "spark.sql.codegen.wholeStage": "true",
    # Shuffle files go as soon as the action that wrote them is over, not when the driver collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# Of landed data: a third to a half of snappy's bytes on the events and envelopes, and no slower.
CODEC = "zstd"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "eventweave") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A scratch folder is made only for a local master without that setting
    (tests, local runs); on a cluster the setting is required and used as is.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir()
    if hasattr(current, "isDefined"):  # scala Option
        current = current.get() if current.isDefined() else None
    if current:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventweave-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def land(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the checkpoint folder and read from there.

    Unlike a checkpointed RDD, readers get only the columns they name, and the
    planner knows the size: a small side is broadcast before the other is shuffled.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)
