"""Footers, in-memory datasets, and the latest table kept up to date."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventweave.operators import convert as cv
from eventweave.options import LineageOptions
from eventweave.plans import lineage as ln
from eventweave.session import checkpoint_dir
from eventweave.sinks import catalog as cat
from eventweave.sinks import targets as tg
from eventweave.sources import footers, memory


def test_footers_of_many_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    pq.write_table(pa.table({"x": pa.array([1, None, 3], pa.uint8()), "l": [[1], [], None]}), tmp_path / "a" / "00001")
    pq.write_table(pa.table({"x": pa.array([4], pa.uint8()), "l": [[1]]}), tmp_path / "a" / "00000")
    pq.write_table(pa.table({"c": pa.array([], pa.string())}), tmp_path / "b" / "00000")
    (tmp_path / "a" / "_SUCCESS").touch()
    pq.write_table(pa.table({"s": pa.array(["u", None, "v"]).dictionary_encode()}), tmp_path / "one.parquet")
    sources = {f"dataset://{n}": f"{tmp_path}/{n}" for n in ("a", "b", "one.parquet")}
    got = {r.dataset: r for r in ln.profile_sources(spark, sources).collect()}
    a = got["a"]
    assert (a.n_files, a.n_rows, a.n_cols, a.n_nulls) == (2, 4, 2, 1) and a.stored_bytes > 0
    assert [(f.name, f.type) for f in a.fields] == [("x", "uint8"), ("l", "list<element: int64>")]
    assert got["b"].n_rows == 0 and got["b"].n_cols == 0 and got["b"].fields is None
    assert got["one.parquet"].n_nulls == 1 and got["one.parquet"].fields[0].type.startswith("dictionary")
    first = {r.dataset: r for r in ln.profile_sources(spark, sources, LineageOptions(first_part_only=True)).collect()}
    assert (first["a"].n_files, first["a"].n_rows) == (1, 1) and first["one.parquet"].n_rows == 3


def test_plan_does_not_grow_with_datasets(spark, tmp_path):
    pq.write_table(pa.table({"x": [1]}), tmp_path / "t.parquet")
    def plan(n):
        rows = [(f"d{k}", f"u{k}", str(tmp_path / "t.parquet")) for k in range(n)]
        return footers.footer_profiles(footers.footers(spark, rows))
    few, many = plan(2), plan(300)
    size = [p._jdf.queryExecution().optimizedPlan().toString().count("\n") for p in (few, many)]
    assert size[0] == size[1] and many.count() == 300


def test_unknown_file_system_is_named(spark):
    with pytest.raises(Exception, match="no Arrow file system"):
        footers.footers(spark, [("d", "u", "nosuch://x/y")]).collect()


# The 21 scalar types whose class must survive.
SCALARS = ([pa.bool_(), pa.int8(), pa.int16(), pa.int32(), pa.int64(), pa.uint8(), pa.uint16(), pa.uint32(),
            pa.float16(), pa.float32(), pa.float64(), pa.string(), pa.binary()]
           + [pa.timestamp(u) for u in ("s", "ms", "us", "ns")] + [pa.duration(u) for u in ("s", "ms", "us", "ns")])


def value_of(kind):
    if pa.types.is_boolean(kind):
        return True
    if pa.types.is_timestamp(kind):
        return dt.datetime(2022, 1, 1, 12)
    if pa.types.is_duration(kind):
        return dt.timedelta(seconds=5)
    if pa.types.is_float16(kind):
        return np.float16(1.5)
    return {pa.string(): "x", pa.binary(): b"x"}.get(kind, 1)


def test_scalar_types_keep_their_class(spark):
    table = pa.table({f"c{k}": pa.array([value_of(t), None], t) for k, t in enumerate(SCALARS)})
    row = memory.profile_memory(spark, table, "scalars").first()
    assert (row.n_rows, row.n_cols, row.nbytes) == (2, 21, table.nbytes)
    assert [f.type for f in row.fields] == [str(t) for t in SCALARS]
    fields = memory.profile_memory(spark, table, "scalars").select(
        F.col("dataset"), F.posexplode("fields").alias("position", "f")).select(
        "dataset", F.col("position").cast("int"), "f.name", F.col("f.type").alias("native_type"), "f.nullable")
    good, bad = cv.all_or_nothing(cv.CatalogSchemaConverter(spark).convert(fields))
    classes = {r.field_path: r.type_class for r in good.collect()}
    assert bad.count() == 0 and len(classes) == 21
    want = ["Boolean"] + ["Number"] * 10 + ["String", "Bytes"] + ["Time"] * 8
    assert [classes[f"c{k}"] for k in range(21)] == want
    rows = memory.memory_frame(spark, table).collect()
    assert rows[0].c0 is True and rows[0].c8 == 1.5 and rows[0].c13 == dt.datetime(2022, 1, 1, 12) and rows[1].c3 is None


def test_frames_and_other_things(spark):
    frame = pd.DataFrame({"A": 1.0, "B": pd.Timestamp("20130102"), "C": pd.Series(1, index=list("wxyz"), dtype="float32"),
                          "E": pd.Categorical(["t", "u", "t", "u"]), "F": "foo"})
    row = memory.profile_memory(spark, frame, "mixed").first()
    assert (row.n_rows, row.n_cols) == (4, 6) and any(f.type.startswith("dictionary") for f in row.fields)
    assert memory.memory_frame(spark, frame).count() == 4
    empty = memory.profile_memory(spark, pa.table({"x": pa.array([], pa.int8())}), "none").first()
    assert (empty.n_rows, empty.n_cols, empty.fields) == (0, 0, None)
    for other in ([1, 2], {"x": 1}, None, "x"):
        with pytest.raises(TypeError):
            memory.as_table(other)


MCE = ("urn string, entity_type string, workflow_id string, aspects array<struct<aspect:string,json:string>>, "
       "run_completed_ns long, grp int, slot long, item long")


def events(spark, run, urns, at):
    return spark.createDataFrame([(u, "dataset", run, [("status", f"{run}")], at, 0, 0, k) for k, u in enumerate(urns)], MCE)


def test_latest_table_reads_and_writes_only_touched_buckets(spark):
    root = f"{checkpoint_dir(spark)}/latest-{uuid.uuid4().hex}"
    many = [f"u{k}" for k in range(200)]
    tg.merge_latest(spark, root, events(spark, "r1", many, 10), "b-0", buckets=16)
    before = {k: v for k, v in tg._versions(root, spark).items()}
    assert len(before) == 16
    for _ in range(2):                                          # a batch merged again adds nothing
        latest = tg.merge_latest(spark, root, events(spark, "r2", ["u3", "new", "u3"], 20), "b-1", buckets=16)
        after = tg._versions(root, spark)
        changed = {k for k in after if after[k] != before.get(k)}
        assert len(changed) <= 2 and all(len(v) == 1 for v in after.values())
        rows = {r.urn: (r.workflow_id, r.n_versions) for r in latest.collect()}
        assert len(rows) == 201 and rows["u3"] == ("r2", 3) and rows["new"] == ("r2", 1) and rows["u7"] == ("r1", 1)
    older = tg.merge_latest(spark, root, events(spark, "r0", ["u3"], 5), "b-2", buckets=16)
    assert {(r.workflow_id, r.n_versions) for r in older.where("urn = 'u3'").collect()} == {("r2", 4)}


def test_catalog_log_is_a_table_that_grows(spark):
    root = f"{checkpoint_dir(spark)}/cat-{uuid.uuid4().hex}"
    writes = spark.createDataFrame(
        [("logdb", f"t{k}", f"{root}/logdb/t{k}/", f"mem://{k}") for k in range(11)] + [(None, "x", f"{root}/x", "mem://x")],
        "db string, table_name string, path string, source string")

    def resolve(uri):
        if uri == "mem://4":
            raise ValueError("gone")
        return spark.range(int(uri.rsplit("/", 1)[1]) + 1)

    log = cat.write_catalog(spark, writes, resolve, parallel=2, log_rows=3)
    got = {r.table_name: r.status for r in log.collect()}
    assert len(got) == 12 and {t for t, s in got.items() if s == "failed"} == {"t4", "x"}
    assert len(log.inputFiles()) > 2
    counts = {r.path.rstrip("/").rsplit("/", 1)[1]: r.n_rows for r in cat.read_back_counts(log).collect()}
    assert counts == {f"t{k}": k + 1 for k in range(11) if k != 4}
