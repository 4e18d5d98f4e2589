"""The hot-key path of ordered_scan equals a plain window."""

import random

from pyspark.sql import functions as F

from eventweave.operators.ordering import ordered_scan, split_hot


def test_bucketed_scan_matches_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    for k, n in (("hot", 400), ("warm", 40), ("cold", 3)):
        for i in range(n):
            t = rnd.choice([None, rnd.randint(0, 50), 10 ** 12 + rnd.randint(0, 5)])
            rows.append((k, t, i, rnd.randint(0, 1), f"x{i}"))
    df = spark.createDataFrame(rows, "k string, t long, s long, v int, name string")
    order = [F.col("t").asc_nulls_first(), F.col("s")]
    plain = ordered_scan(df, "k", order, sums={"cv": F.col("v")}, prev={"pn": "name"})
    d, bucket = split_hot(df, "k", "t", 10)
    split = ordered_scan(d, "k", order, bucket=bucket, sums={"cv": F.col("v")}, prev={"pn": "name"})
    cols = ["k", "s", "_pos", "cv", "pn"]
    a = sorted((tuple(r) for r in plain.select(*cols).collect()), key=str)
    b = sorted((tuple(r) for r in split.select(*cols).collect()), key=str)
    assert a == b
    assert split_hot(df, "k", "t", 1000)[1] is None


def test_clustered_values_split_evenly(spark):
    """One key holds nearly all rows, its values in two far clusters: no bucket holds twice the mean."""
    rows = [("hot", k if k % 2 else 10 ** 15 + k) for k in range(4000)] + [("cold", k) for k in range(50)]
    d, bucket = split_hot(spark.createDataFrame(rows, "k string, t long"), "k", "t", 200)
    sizes = [r["n"] for r in d.filter("k = 'hot'").groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 15 and max(sizes) < 2 * sum(sizes) / len(sizes)
