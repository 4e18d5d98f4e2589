"""Positions, running sums and previous-row values within a key, skew aware.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. A
run may hold a large share of all rows, so callers pass a *bucket* column:
an order-preserving split of a key into sub-ranges (bucket ``b`` holds only
rows that sort before those of ``b + 1``). The windows then run per
``(key, bucket)`` and a small per-``(key, bucket)`` table (at most the
number of buckets per key) adds the counts and sums of all earlier
buckets. With no bucket column this is a single window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_hot(df: DataFrame, key: str | Sequence[str], value: str,
              hot_rows: int) -> tuple[DataFrame, Column | None]:
    """(``df``, bucket column) for ``ordered_scan``; None when no key has more than ``hot_rows`` rows.

    The values of a hot key are cut at their own quantiles, as many as leave
    about ``hot_rows`` rows in each bucket, so clustered values split as well
    as even ones. Equal values share a bucket and NULL is in the first, as it
    sorts first, so bucket order equals value order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(hot_rows))
    largest = counts.agg(F.max("_n")).first()[0]
    if largest is None:
        return df, None
    n = -(-largest // hot_rows)
    cuts = F.percentile_approx(value, [k / n for k in range(1, n)] or [0.5], 100 * n)
    bounds = (df.join(counts.select(*keys), keys, "left_semi").groupBy(*keys)
              .agg(F.array_distinct(cuts).alias("_cuts"))).checkpoint()
    bucket = F.coalesce(F.size(F.filter("_cuts", lambda x: x < F.col(value))), F.lit(0)).cast("bigint")
    bucket = F.when(F.col("_cuts").isNull() | F.col(value).isNull(), F.lit(0).cast("bigint")).otherwise(bucket)
    return df.join(bounds, keys, "left"), bucket


def ordered_scan(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str],
                 bucket: Column | None = None, sums: dict[str, Column] | None = None,
                 prev: dict[str, str] | None = None, pos_col: str = "_pos") -> DataFrame:
    """Add ``pos_col`` (0-based position in ``order`` within ``key``).

    ``sums``: name -> column; adds the inclusive running sum as ``name``.
    ``prev``: new name -> column; adds that column's value on the previous
    row (NULL on the first row of the key).
    """
    keys = [key] if isinstance(key, str) else list(key)
    sums = sums or {}
    prev = prev or {}
    d = df
    for name, c in sums.items():
        d = d.withColumn(f"_v_{name}", c.cast("bigint"))
    parts = keys + (["_b"] if bucket is not None else [])
    if bucket is not None:
        # Explicit exchange on (key, bucket): an input already hash-partitioned
        # by the key alone would satisfy the window's distribution and keep a
        # hot key in one task; this spreads its sub-ranges over many tasks.
        d = d.withColumn("_b", bucket).repartition(*[F.col(p) for p in parts])
    w = Window.partitionBy(*parts).orderBy(*order)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_loc", (F.row_number().over(w) - 1).cast("bigint"))
    for name in sums:
        d = d.withColumn(f"_r_{name}", F.sum(f"_v_{name}").over(wr))
    for name, src in prev.items():
        d = d.withColumn(f"_p_{name}", F.lag(src).over(w))

    if bucket is None:
        out = d.withColumnRenamed("_loc", pos_col)
        for name in sums:
            out = out.withColumnRenamed(f"_r_{name}", name)
        for name in prev:
            out = out.withColumnRenamed(f"_p_{name}", name)
        return out.drop(*[f"_v_{n}" for n in sums])

    # Per (key, bucket) totals: a key's rows over hot_rows of them.
    aggs = [F.count(F.lit(1)).alias("_c")]
    aggs += [F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    aggs += [F.max_by(src, "_loc").alias(f"_l_{n}") for n, src in prev.items()]
    tot = d.groupBy(*parts).agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy("_b")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")]
    off_cols += [F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]
    off_cols += [F.lag(f"_l_{n}").over(wk).alias(f"_q_{n}") for n in prev]
    off = tot.select(*parts, *off_cols)
    out = d.join(off, parts).withColumn(pos_col, F.col("_loc") + F.col("_off"))
    for name in sums:
        out = out.withColumn(name, F.col(f"_r_{name}") + F.col(f"_o_{name}"))
    for name in prev:
        out = out.withColumn(name, F.when(F.col("_loc") == 0, F.col(f"_q_{name}"))
                             .otherwise(F.col(f"_p_{name}")))
    drop = ["_b", "_loc", "_off", "_cuts"] + [f"_{p}_{n}" for n in sums for p in "vro"]
    drop += [f"_{p}_{n}" for n in prev for p in "pq"]
    return out.drop(*drop)
