"""What the jobs leave on disk: landed codecs, shuffle files, columns behind an exchange."""

import glob
import random
import re
import time
import uuid

from pyspark.sql import functions as F

from eventweave.operators import chain as ch
from eventweave.operators import gate as gt
from eventweave.operators import replay as rp
from eventweave.plans import queries as q
from eventweave.session import apply_job_conf, checkpoint_dir
from helpers import SF001, events_frame


def codecs(root):
    import pyarrow.parquet as pq
    files = glob.glob(f"{root.removeprefix('file:')}/**/*.parquet", recursive=True)
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}


def exchanged(df, key):
    """The columns that the exchange by ``key`` gets, from the analysed and optimized plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = [n for n in text.split("\n\n") if " Exchange" in n and f"hashpartitioning({key}#" in n]
    return [{c.split("#")[0].strip() for c in re.search(r"Input \[\d+\]: \[(.*)\]", n)[1].split(",")} for n in nodes]


def test_the_envelope_log_is_landed_in_few_bytes(spark):
    log = q._landed_envelopes(spark, SF001)
    root = log.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    assert codecs(root) == {"ZSTD"} and log.count() == q.envelopes(spark, SF001).count()


def test_shuffle_files_go_with_their_action(spark):
    apply_job_conf(spark)
    folders = spark.sparkContext._jvm.org.apache.spark.util.Utils.getConfiguredLocalDirs(
        spark.sparkContext._jsc.sc().conf())

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = files()
    spark.range(100_000).repartition(7, "id").write.parquet(f"{checkpoint_dir(spark)}/gone-{uuid.uuid4().hex}")
    until = time.time() + 10
    while files() - before and time.time() < until:        # files go a moment later
        time.sleep(0.1)
    assert not files() - before


def tied_events(spark):
    pick = random.Random(5)
    runs = {f"x{k}": [pick.choice(["r", "S", "T0", "N0", "E", "W4", "T1"]) for _ in range(30)] for k in range(6)}
    ev = events_frame(spark, runs, {(r, i): i // 7 for r in runs for i in range(30)})
    return ev.withColumn("arrival_seq", F.expr("arrival_seq div 4")).unionByName(ev.limit(20))


def test_only_the_columns_asked_for_are_ordered(spark):
    ev, asked = tied_events(spark), ["kind", "phase", "occurred_at_ns", "arrival_seq", "node_id"]
    stats = gt.run_stats(ev)
    few, all_ = (ch.event_positions(ev, stats, None, columns=k) for k in (asked, None))
    assert exchanged(few, "workflow_id") == [{"workflow_id", *asked}]
    some = ["workflow_id", "event_pos", *asked]
    assert sorted(map(str, few.select(some).collect())) == sorted(map(str, all_.select(some).collect()))
    small = q.LineageOptions(hot_group_rows=4)
    hot = ch.event_positions(ev, stats, None, small, asked).select(some)
    assert sorted(map(str, hot.collect())) == sorted(map(str, few.select(some).collect()))


def test_the_gate_shuffles_order_keys_only(spark):
    cuts = rp.prefix_epochs(tied_events(spark))
    assert exchanged(cuts, "workflow_id") == [{"workflow_id", *rp.GATE_ORDER}]
    first = rp.first_cuts(tied_events(spark))
    assert "ExistingRDD" not in str(first._jdf.queryExecution().executedPlan())      # landed as Parquet, not as rows
    root = first.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    assert codecs(root) == {"ZSTD"}
