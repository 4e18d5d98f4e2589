"""Datasets that are in memory as Arrow tables or pandas frames.

Their schema is described by Arrow's own type names, before Spark's types
widen or drop some (unsigned, half float, dictionary, second and millisecond
times); the rows come along as a DataFrame where columns that Spark lacks are
cast to the next type that it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PROFILE = ("dataset string, uri string, n_rows long, n_cols int, nbytes long, "
           "fields array<struct<name:string,type:string,nullable:boolean>>, raw_schema string")


def as_table(dataset):
    """An Arrow table; a pandas frame's index is a column where it isn't the default one."""
    import pandas as pd
    import pyarrow as pa
    if isinstance(dataset, pa.Table):
        return dataset
    if isinstance(dataset, pd.DataFrame):
        return pa.Table.from_pandas(dataset)
    raise TypeError(f"neither an Arrow table nor a pandas frame: {type(dataset).__name__}")


def profile_memory(spark: SparkSession, dataset, name: str, uri: str | None = None) -> DataFrame:
    """The profile row of an in-memory dataset: rows, columns, Arrow's bytes, fields with Arrow's type names.

    A table without rows has no schema, as in the reference: 0 columns, no fields.
    """
    table = as_table(dataset)
    if not table.num_rows:
        row = (name, uri, 0, 0, 0, None, None)
    else:
        fields = [(str(f.name), str(f.type), f.nullable) for f in table.schema]
        text = "\n".join(f"{n}: {t}" + ("" if nullable else " not null") for n, t, nullable in fields)
        row = (name, uri, table.num_rows, table.num_columns, table.nbytes, fields, text)
    return spark.createDataFrame([row], PROFILE)


def _spark_type(kind):
    """The Arrow type that Spark reads in place of one it lacks."""
    import pyarrow as pa
    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(),
             pa.uint64(): pa.decimal128(20, 0), pa.float16(): pa.float32()}
    if pa.types.is_dictionary(kind):
        return _spark_type(kind.value_type)
    if pa.types.is_timestamp(kind):
        return pa.timestamp("us", kind.tz)
    if pa.types.is_duration(kind):
        return pa.duration("us")
    if pa.types.is_time(kind):
        return pa.string()
    if pa.types.is_date64(kind):
        return pa.date32()
    return wider.get(kind, kind)


def memory_frame(spark: SparkSession, dataset) -> DataFrame:
    """The rows of an in-memory dataset as a DataFrame."""
    import pyarrow as pa
    table = as_table(dataset)
    columns = []
    for k, field in enumerate(table.schema):
        column, want = table.column(k), _spark_type(field.type)
        if pa.types.is_float16(field.type):
            column = pa.chunked_array([pa.array(column.to_pylist(), pa.float32())])
        elif want != field.type:
            column = column.cast(want, safe=False)
        columns.append(column)
    return spark.createDataFrame(pa.table(columns, names=[str(n) for n in table.schema.names]))
