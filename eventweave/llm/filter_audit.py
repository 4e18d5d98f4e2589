"""Interaction audit of five document filters by a stream with retractions.

The files of a table are read as available-now micro-batches. Each document's
failures of the filters A to D are bits of a mask, SQL expressions on its
text. Whether it repeats a smaller doc_id's text (E) depends on all other
documents, seen or not. The state keyed by text holds the smallest doc_id so
far and the counters in which its documents stand. A document counts as the
first of its text until a smaller doc_id is known; then its mask is retracted
from the counters and entered again with E, be it of this micro-batch or of an
earlier one. The sum of all changes per (part, mask, quality, toxic) is the
audit's only input, 32 masks a part; every order of the filters is arithmetic
on those.

Documents of one text are counted together inside a task before they go to
the text's state, so a text that a third of all rows share reaches it as a
few rows a task. Rows that stand behind a smaller doc_id of their own task
fail E for good and are only counted.

The state is a table in the shared folder, one part for each micro-batch: the
rows that became the least of their text in it. A batch joins it by one
exchange of narrow rows, all SQL; a part is named by its batch and replaces
itself when the stream repeats a batch after a failure.

Defined results: a null text is an empty one, a null source the part ''.
Rows without doc_id are neither smaller than others nor behind any: they
never fail E. Rows of equal doc_id and text don't fail it either (no smaller
one), each counts. Of several label rows for a doc_id one with quality 1 (or
toxic 1) is enough. An empty table has no parts and no rows. Columns other
than doc_id, text and source are ignored.
"""

from __future__ import annotations

import uuid
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm.tables import arrow_schema, land, scratch_root

FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
SETS = range(32)

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"

HELD = 50_000       # texts counted in a task before they are passed on
SEEN = ("key binary, mask int, part string, good boolean, toxic boolean, id long, n_least long, n_behind long, "
        "n_free long")
STATE_KEY = ["key", "mask", "part", "good", "toxic", "id"]
JUDGED = ("key binary, mask int, part string, good boolean, toxic boolean, id long, n long, old boolean, "
          "least long, least_before long")
CHANGE = "part string, mask int, good boolean, toxic boolean, change long"


def failures(text: Column) -> Column:
    """The bits of the filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def masks(w: Column) -> Column:
        n = F.size(w).cast("long")
        capitals = F.char_length(F.regexp_replace(text, "[^A-Z]", "")).cast("long")
        return (F.when(n < MIN_WORDS, BIT["A"]).otherwise(0)
                + F.when(100 * F.size(F.array_distinct(w)).cast("long") < MIN_DISTINCT_PERCENT * n, BIT["B"])
                .otherwise(0)
                + F.when(100 * capitals > MAX_CAPITALS_PERCENT * F.char_length(text), BIT["C"]).otherwise(0)
                + F.when(text.rlike(SYMBOLS), BIT["D"]).otherwise(0))
    return F.transform(F.array(words), masks)[0].cast("int")


def _seen(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, mask, part, good, toxic, doc_id) of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
        failures(text).alias("mask"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    # rows without doc_id are spread by their text; no label has the second key
    keyed = narrow.select("*", F.coalesce("doc_id", F.xxhash64("key")).alias("label_id"),
                          F.col("doc_id").isNotNull().alias("named"))
    return keyed.join(labels, ["label_id", "named"], "left").select(
        "key", "mask", "part", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc_id")


def _marks(labels: DataFrame) -> DataFrame:
    return land(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    ).withColumn("named", F.lit(True)), "labels")


def count_in_task(batches):
    """Documents of a task by text, part and labels: the least doc_id, how many have it, how many stand behind it."""
    import pyarrow as pa
    schema = arrow_schema(SEEN)

    def out(table):
        rows = [(*group, *seen) for group, seen in table.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    table: dict[tuple, list] = {}
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *group, doc_id in zip(*columns):
            seen = table.setdefault(tuple(group), [None, 0, 0, 0])
            if doc_id is None:
                seen[3] += 1
            elif seen[0] is None or doc_id < seen[0]:
                seen[2] += seen[1]
                seen[0], seen[1] = doc_id, 1
            elif doc_id == seen[0]:
                seen[1] += 1
            else:
                seen[2] += 1
        if len(table) >= HELD:
            yield out(table)
            table = {}
    if table:
        yield out(table)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _changes(rows: DataFrame, mask: Column, n: Column) -> DataFrame:
    return rows.select("part", mask.alias("mask"), "good", "toxic", n.alias("change"))


def judge(new: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of a micro-batch and of the state by text, with the least doc_id before and after the batch.

    ``held`` may hold rows that were retracted before. Returned are all new
    rows and those of the state that are retracted now.
    """
    both = new.withColumn("old", F.lit(False)).unionByName(held.withColumn("old", F.lit(True)))
    text = Window.partitionBy("key")
    both = both.withColumn("least", F.min("id").over(text)).withColumn(
        "least_before", F.min(F.when(F.col("old"), F.col("id"))).over(text))
    return both.where("not old or (id = least_before and least < least_before)")


def _stream(spark: SparkSession, path: str, micro_batches: int) -> DataFrame:
    """The Parquet table at ``path``, a folder or one file, in about ``micro_batches`` rounds of its files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files = max(1, -(-fs.getContentSummary(p).getFileCount() // micro_batches))
    # a file source streams folders and globs; the glob below matches the one file
    source = f"{path[:-1]}[{path[-1]}]" if fs.getFileStatus(p).isFile() else path
    return (spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
            .option("maxFileAge", "36500d").parquet(source))


def counters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = 4) -> DataFrame:
    """(part, mask, good, toxic, n) over all documents of the Parquet table at ``path``.

    Its files are streamed in about ``micro_batches`` rounds, whatever their
    number; checkpoint, state and changes are in the shared folder.
    """
    base = f"{scratch_root(spark)}/llm-audit-{uuid.uuid4().hex}"
    marks = _marks(labels)
    behind = F.col("mask").bitwiseOR(BIT["E"])

    def on_batch(batch: DataFrame, number: int) -> None:
        def part(name: str, k: int = number) -> str:
            return f"{base}/{name}/batch-{k:06d}"
        read = batch.sparkSession.read
        _seen(batch, marks).mapInArrow(count_in_task, SEEN).write.mode("overwrite").parquet(part("counted"))
        counted = read.schema(SEEN).parquet(part("counted"))
        new = counted.where("id is not null").select(*STATE_KEY, F.col("n_least").alias("n"))
        held = (read.schema(JUDGED).parquet(*[part("judged", k) for k in range(number)])
                .where("not old and id = least").select(*STATE_KEY, "n") if number else new.where("false"))
        judge(new, held).write.mode("overwrite").parquet(part("judged"))
        wrong = read.schema(JUDGED).parquet(part("judged")).where("id > least")
        changes = (_changes(counted, F.col("mask"), F.col("n_least") + F.col("n_free"))
                   .union(_changes(counted, behind, F.col("n_behind")))
                   .union(_changes(wrong, F.col("mask"), -F.col("n")))
                   .union(_changes(wrong, behind, F.col("n"))))
        (changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("change").alias("change"))
         .write.mode("overwrite").parquet(part("changes")))

    query = (_stream(spark, path, micro_batches).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    changes = spark.createDataFrame([], CHANGE)
    if _exists(spark, f"{base}/changes"):
        changes = spark.read.schema(CHANGE).option("recursiveFileLookup", "true").parquet(f"{base}/changes")
    return (changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("change").alias("n")).where("n <> 0"))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, set of the filters before it, its bit) of all permutations of the filters."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(order), step, before, BIT[f]))
            before |= BIT[f]
    return out


def interactions(counted: DataFrame) -> DataFrame:
    """One row per part, filter order and step from ``counters``; see ``audit``."""
    def outside(s: int, which: Column) -> Column:
        """Documents that fail none of the filters of a set."""
        return F.coalesce(F.sum(F.when((F.col("mask").bitwiseAND(s) == 0) & which, F.col("n"))), F.lit(0))

    every = F.lit(True)
    sums = counted.groupBy("part").agg(
        F.array(*[outside(s, every) for s in SETS]).alias("kept_by"),
        F.array(*[outside(s, F.col("good")) for s in SETS]).alias("good_by"),
        F.array(*[outside(s, F.col("toxic")) for s in SETS]).alias("toxic_by"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == BIT[f], F.col("n"))), F.lit(0)) for f in FILTERS])
        .alias("only"))
    weight = [24, 6, 4, 6, 24]      # orders in which exactly a given set of k filters stands before one
    shares = []
    for f in FILTERS:
        terms = [weight[bin(s).count("1")] * (F.col("kept_by")[s] - F.col("kept_by")[s | BIT[f]])
                 for s in SETS if not s & BIT[f]]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        shares.append(total)
    sums = sums.withColumn("shares", F.array(*shares))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(s).alias("s"),
                               F.lit(b).alias("b")) for o, k, s, b in orders()])
    rows = sums.withColumn("at", F.explode(steps)).select("*", "at.*")

    def lost(column: str) -> Column:
        return (F.element_at(column, F.col("s") + 1)
                - F.element_at(column, F.col("s").bitwiseOR(F.col("b")) + 1))
    own = F.element_at("kept_by", F.lit(1)) - F.element_at("kept_by", F.col("b") + 1)
    place = F.log2(F.col("b").cast("double")).cast("int") + 1
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        F.element_at("kept_by", F.col("s").bitwiseOR(F.col("b")) + 1).alias("kept"), lost("kept_by").alias("removed"),
        (own - lost("kept_by")).alias("redundant"), F.element_at("only", place).alias("unique_fails"),
        lost("good_by").alias("good_lost"), lost("toxic_by").alias("toxic_lost"),
        F.element_at("shares", place).alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = 4) -> DataFrame:
    """Per part, filter order and step, over the documents of the Parquet table at ``path``:

    kept (after the step), removed (at it), redundant (fail the step's filter,
    removed before), unique_fails (fail no other), good_lost and toxic_lost
    (removed with quality 1, toxic 1), shapley (removed by the step's filter,
    summed over all orders). Odd rows as in the module's text.
    """
    return interactions(counters(spark, path, labels, micro_batches))
