"""Schema converter: the reference's accepted Arrow types, rejects, Spark type names."""

from pyspark.sql import types as T

from eventweave.operators import convert as cv
from eventweave.operators import profile as pf

ALL_SCALARS = ["bool", "int8", "int16", "int32", "int64", "uint8", "uint16", "uint32",
               "halffloat", "float", "double", "string", "binary", "timestamp[s]",
               "timestamp[ms]", "timestamp[us]", "timestamp[ns]", "duration[s]", "duration[ms]",
               "duration[us]", "duration[ns]"]


def convert(spark, types, strict=True, type_map=None):
    fields = cv.fields_frame(spark, {"ds": [(i, f"c{i}", t, True) for i, t in enumerate(types)]})
    return cv.CatalogSchemaConverter(spark, type_map, strict).convert(fields)


def test_all_21_scalars_convert(spark):
    good, bad = cv.all_or_nothing(convert(spark, ALL_SCALARS))
    assert good.count() == 21 and bad.count() == 0


def test_complex_by_prefix(spark):
    got = {r.native_type: r.type_class for r in convert(
        spark, ["list<element: string>", "dictionary<values=string, indices=int8>",
                "date32[day]"]).collect()}
    assert got == {"list<element: string>": "Array",
                   "dictionary<values=string, indices=int8>": "Map", "date32[day]": "Date"}


def test_unknown_type_rejects_whole_dataset(spark):
    empty = spark.createDataFrame([], "native_type string, type_class string")
    good, bad = cv.all_or_nothing(convert(spark, ["bool"], type_map=empty))
    assert good.count() == 0
    r = bad.first()
    assert r.first_bad == "c0" and r.n_bad_fields == 1


def test_strict_and_lenient(spark):
    types = ["struct<k: int64>", "timestamp[us, tz=UTC]", "decimal128(20, 0)", "decimal128(10, 2)"]
    strict = {r.native_type: r.type_class for r in convert(spark, types).collect()}
    assert strict == {"struct<k: int64>": None, "timestamp[us, tz=UTC]": None,
                      "decimal128(20, 0)": "Number", "decimal128(10, 2)": None}
    lenient = {r.native_type: r.type_class for r in convert(spark, types, strict=False).collect()}
    assert lenient == {"struct<k: int64>": "Record", "timestamp[us, tz=UTC]": "Time",
                       "decimal128(20, 0)": "Number", "decimal128(10, 2)": "Number"}


def test_spark_type_names():
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.BooleanType()),
                      T.StructField("c", T.ArrayType(T.FloatType())),
                      T.StructField("d", T.TimestampNTZType()), T.StructField("e", T.DateType()),
                      T.StructField("f", T.BinaryType(), False)])
    assert pf.schema_fields(s) == [
        (0, "a", "int64", True), (1, "b", "bool", True), (2, "c", "list<element: float>", True),
        (3, "d", "timestamp[us]", True), (4, "e", "date32[day]", True), (5, "f", "binary", False)]


def test_json_record_with_lists_and_null(spark):
    rec = '{"id": 7, "label": "beta", "parts": ["left", "right"], "none_yet": [], "ratio": 0.25, "missing": null}'
    df = spark.read.json(spark.sparkContext.parallelize([rec]))
    fields = cv.fields_frame(spark, {"rec": pf.schema_fields(df.schema)})
    got = {r.field_path: r.type_class for r in
           cv.CatalogSchemaConverter(spark, strict=False).convert(fields).collect()}
    # the null column reads as string in Spark; an empty list as array<string>
    assert got == {"id": "Number", "label": "String", "parts": "Array", "none_yet": "Array",
                   "ratio": "Number", "missing": "String"}


def test_replaced_type_table(spark):
    """A caller's table replaces the mapping."""
    own = spark.createDataFrame([("int64", "Counter")], "native_type string, type_class string")
    got = {r.native_type: r.type_class for r in convert(spark, ["int64", "bool"], type_map=own).collect()}
    assert got == {"int64": "Counter", "bool": None}
