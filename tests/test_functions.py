"""Scalar rules: version cast, completed text, names, URNs, audit stamp, hash."""

import hashlib

from pyspark.sql import functions as F

from eventweave.functions import columns as fc
from eventweave.operators import entities as en
from eventweave.operators import profile as pf


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_version_number(spark):
    vals = ["7", " 7 ", "+3", "1_000", "1.5", "abc", "", "-2", "9999999999", None]
    got = one(spark, fc.version_number(F.col("v")), [(v,) for v in vals], "v string")
    assert got == [7, 7, 3, 1000, 0, 0, 0, -2, 9999999999, 0]


def test_completed_text(spark):
    base = 1641038400 * 10 ** 9  # 2022-01-01 12:00:00 UTC
    got = one(spark, fc.ns_to_text(F.col("n")), [(base,), (base + 1_500_000,), (base + 999,)],
              "n bigint")
    assert got == ["2022-01-01 12:00:00", "2022-01-01 12:00:00.001500", "2022-01-01 12:00:00"]


def test_names(spark):
    df = spark.createDataFrame([("left.mid.right", "k8z-n0-0"), ("alone", "x")], "n string, g string")
    got = df.select(fc.before_last_dot(F.col("n")), fc.before_first_dash(F.col("g"))).collect()
    assert [tuple(r) for r in got] == [("left.mid", "k8z"), ("", "x")]


def test_first_log_or_empty(spark):
    got = one(spark, fc.first_or_empty(F.col("a")), [([],), (["u1", "u2"],), (None,)],
              "a array<string>")
    assert got == ["", "u1", ""]


def test_urns(spark):
    df = spark.createDataFrame([("billing", "billing.nightly.load", "invoices")], "f string, t string, d string")
    r = df.select(fc.flow_urn(F.col("f")), fc.job_urn(F.col("f"), F.col("t")),
                  fc.dataset_urn(F.col("d"))).first()
    assert r[0] == "urn:li:dataFlow:(flyte,billing,DEV)"
    assert r[1] == "urn:li:dataJob:(urn:li:dataFlow:(flyte,billing,DEV),billing.nightly.load)"
    assert r[2] == "urn:li:dataset:(urn:li:dataPlatform:flyte,invoices,DEV)"


def test_audit_stamp(spark):
    ns = 1641038400 * 10 ** 9
    r = spark.createDataFrame([(ns,)], "n bigint").select(en.audit_stamp(F.col("n")).alias("a")).first().a
    assert r.time == 1641038400000
    assert r.actor == "urn:li:corpuser:flyte_executor"


def test_schema_hash_fixed_value(spark):
    fields = [("k", "string", True), ("flag", "bool", True), ("n", "int64", True)]
    df = spark.createDataFrame([("ledger", fields)],
                               "n string, f array<struct<name:string,type:string,nullable:boolean>>")
    assert df.select(pf.schema_hash(F.col("n"), F.col("f"))).first()[0] == \
        hashlib.md5(b"ledgerboolint64string").hexdigest()


def test_shape_text(spark):
    r = spark.range(1).select(pf.shape_text(F.lit(4), F.lit(7))).first()[0]
    assert r == "(4, 7)"


def test_completed_text_in_any_session_zone(spark):
    ns = 1641038400 * 10 ** 9
    held = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, fc.ns_to_text(F.col("n")), [(ns,), (ns + 5_000_000,)], "n bigint") == [
                "2022-01-01 12:00:00", "2022-01-01 12:00:00.005000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)
