"""Dataset profiles: shape, in-memory bytes, Arrow-style field types, fingerprint.

One aggregate pass per dataset computes the row count, every column's
non-null count and the variable-width byte sums (partial aggregation, so a
large dataset is profiled by all its scan tasks). Field names and types come
from the DataFrame schema (metadata, known on the driver without a scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweave.functions.columns import c

# Arrow type names used by the reference's type table, and the
# Arrow buffer width in bytes of each fixed-width type.
_SIMPLE = {
    T.BooleanType: "bool", T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32",
    T.LongType: "int64", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string",
    T.CharType: "string", T.VarcharType: "string", T.BinaryType: "binary",
    T.DateType: "date32[day]", T.TimestampNTZType: "timestamp[us]",
    T.DayTimeIntervalType: "duration[us]", T.NullType: "null",
}
_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampNTZType: 8, T.TimestampType: 8,
    T.DayTimeIntervalType: 8, T.DecimalType: 16, T.YearMonthIntervalType: 4,
}
if hasattr(T, "TimeType"):
    _SIMPLE[T.TimeType] = "time64[us]"
    _WIDTH[T.TimeType] = 8


def arrow_type_name(dt: T.DataType, session_tz: str = "UTC") -> str:
    """Arrow's printed type name for a Spark type (what ``str(field.type)`` gives)."""
    for cls, name in _SIMPLE.items():
        if type(dt) is cls:
            return name
    if isinstance(dt, T.TimestampType):
        return f"timestamp[us, tz={session_tz}]"
    if isinstance(dt, T.DecimalType):
        return f"decimal128({dt.precision}, {dt.scale})"
    if isinstance(dt, T.ArrayType):
        return f"list<element: {arrow_type_name(dt.elementType, session_tz)}>"
    if isinstance(dt, T.MapType):
        return (f"map<{arrow_type_name(dt.keyType, session_tz)}, "
                f"{arrow_type_name(dt.valueType, session_tz)}>")
    if isinstance(dt, T.StructType):
        inner = ", ".join(f"{f.name}: {arrow_type_name(f.dataType, session_tz)}" for f in dt.fields)
        return f"struct<{inner}>"
    if isinstance(dt, T.YearMonthIntervalType):
        return "month_interval"
    return dt.simpleString()


def schema_fields(schema: T.StructType, session_tz: str = "UTC") -> list[tuple]:
    """(position, name, arrow type, nullable) of every top-level column."""
    return [(i, f.name, arrow_type_name(f.dataType, session_tz), bool(f.nullable))
            for i, f in enumerate(schema.fields)]


def _width(dt: T.DataType) -> int | None:
    for cls, w in _WIDTH.items():
        if isinstance(dt, cls):
            return w
    return None


def _value_bytes(col: Column, dt: T.DataType) -> Column | None:
    """Per-row variable bytes of a column (data buffers beyond the fixed part)."""
    if isinstance(dt, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        return F.octet_length(col)
    if isinstance(dt, T.ArrayType):
        return _list_bytes(col, dt.elementType)
    if isinstance(dt, T.MapType):
        return _list_bytes(F.map_keys(col), dt.keyType) + _list_bytes(F.map_values(col), dt.valueType)
    if isinstance(dt, T.StructType):
        return _child_bytes(col, dt)
    return None


def _list_bytes(col: Column, element: T.DataType) -> Column:
    """Bytes of the child array of one list value."""
    n = F.coalesce(F.array_size(col), F.lit(0)).cast("bigint")
    w = _width(element)
    if w is not None:
        return n * F.lit(w)
    if isinstance(element, T.BooleanType):
        return F.ceil(n / F.lit(8))
    return F.coalesce(F.aggregate(col, F.lit(0).cast("bigint"),
                                  lambda acc, x: acc + _child_bytes(x, element)), F.lit(0).cast("bigint"))


def _child_bytes(col: Column, dt: T.DataType) -> Column:
    """Bytes of one value in a child array: its fixed part, offsets and what they point at."""
    w = _width(dt)
    if w is not None:
        return F.lit(w).cast("bigint")
    if isinstance(dt, T.StructType):
        out = F.lit(0).cast("bigint")
        for f in dt.fields:
            out = out + _child_bytes(col[f.name], f.dataType)
        return out
    if isinstance(dt, T.BooleanType):
        return F.lit(0).cast("bigint")      # a bit; below the estimate's grain
    inner = _value_bytes(col, dt)
    return F.lit(4).cast("bigint") + (F.lit(0) if inner is None else F.coalesce(inner, F.lit(0))).cast("bigint")


def profile_aggs(schema: T.StructType) -> tuple[list[Column], Column, Column]:
    """Aggregate expressions plus the final ``nbytes`` and ``n_rows`` expressions.

    Bytes follow Arrow's buffers: fixed width = rows x width; bool =
    ceil(rows/8); string/binary = value bytes + 4 x rows (offsets); list =
    4 x rows + child bytes; plus ceil(rows/8) for a column with nulls.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    parts: list[Column] = []
    rows = F.col("_rows")
    validity = F.ceil(rows / F.lit(8))
    for i, f in enumerate(schema.fields):
        col = F.col(f"`{f.name}`")
        aggs.append(F.count(col).alias(f"_nn{i}"))
        has_nulls = F.col(f"_nn{i}") < rows
        part = F.when(has_nulls, validity).otherwise(F.lit(0))
        dt = f.dataType
        w = _width(dt)
        if isinstance(dt, T.BooleanType):
            part = part + validity
        elif w is not None:
            part = part + rows * F.lit(w)
        else:
            vb = _value_bytes(col, dt)
            if vb is not None:
                aggs.append(F.coalesce(F.sum(vb), F.lit(0)).cast("bigint").alias(f"_vb{i}"))
                offsets = rows * F.lit(4) if isinstance(
                    dt, (T.StringType, T.BinaryType, T.CharType, T.VarcharType, T.ArrayType, T.MapType)) \
                    else F.lit(0)
                part = part + offsets + F.col(f"_vb{i}")
        parts.append(part)
    nbytes = F.lit(0).cast("bigint")
    for p in parts:
        nbytes = nbytes + p
    return aggs, nbytes.cast("bigint"), rows.cast("bigint")


def profile(df: DataFrame, dataset: str, uri: str | None = None,
            empty_as_unknown: bool = False) -> DataFrame:
    """C1 + A7: one row: dataset, uri, n_rows, n_cols, nbytes, fields, raw schema text."""
    spark = df.sparkSession
    tz = spark.conf.get("spark.sql.session.timeZone", "UTC")
    aggs, nbytes, rows = profile_aggs(df.schema)
    fields = schema_fields(df.schema, tz)
    field_arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"),
                                   F.lit(nl).alias("nullable")) for _, n, t, nl in fields])
    raw = "\n".join(f"{n}: {t}" + ("" if nl else " not null") for _, n, t, nl in fields)
    out = df.agg(*aggs).select(
        F.lit(dataset).alias("dataset"),
        F.lit(uri).cast("string").alias("uri"),
        rows.alias("n_rows"),
        F.lit(len(fields)).cast("int").alias("n_cols"),
        nbytes.alias("nbytes"),
        field_arr.alias("fields"),
        F.lit(raw).alias("raw_schema"),
    )
    if empty_as_unknown:
        # parity: an empty table is falsy in the reference, so no schema and shape (0, 0)
        empty = c("n_rows") == 0
        out = (out.withColumn("n_cols", F.when(empty, F.lit(0)).otherwise(c("n_cols")))
               .withColumn("nbytes", F.when(empty, F.lit(0).cast("bigint")).otherwise(c("nbytes")))
               .withColumn("fields", F.when(~empty, c("fields"))))
    return out


def profile_many(spark: SparkSession, frames: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Profiles of several datasets as one union: one job, each dataset one scan."""
    out = None
    for name, (df, uri) in frames.items():
        p = profile(df, name, uri)
        out = p if out is None else out.unionByName(p)
    return out


def schema_hash(name: Column, fields: Column) -> Column:
    """md5 of the dataset name + its field type names, sorted and concatenated."""
    types = F.transform(fields, lambda f: f["type"])
    return F.md5(F.concat(name, F.array_join(F.array_sort(types), "")))


def shape_text(n_rows: Column, n_cols: Column) -> Column:
    """Python's ``str((rows, cols))``."""
    return F.concat(F.lit("("), n_rows.cast("string"), F.lit(", "), n_cols.cast("string"),
                    F.lit(")"))


def merge_metadata(metadata: Column, n_rows: Column, n_cols: Column, nbytes: Column) -> Column:
    """A copy of the metadata map plus ``shape`` and ``nbytes`` as text.

    The two computed entries overwrite keys of the same name (``map_concat``
    rejects duplicate keys, so they are filtered out of the copy first).
    """
    kept = F.map_filter(metadata, lambda k, v: ~k.isin("shape", "nbytes"))
    return F.map_concat(kept, F.create_map(F.lit("shape"), shape_text(n_rows, n_cols),
                                           F.lit("nbytes"), nbytes.cast("string")))
