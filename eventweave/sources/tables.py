"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver's table names, in the order of TESTDATA.md.
# The position of a table in this list is its dataset number in the adapter.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; naming columns prunes the parquet read to them."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
