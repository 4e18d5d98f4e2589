"""Merkle fingerprints of documents: a hash tree over sections, paragraphs and phrases.

A text is cut into sections (ended by a blank line), those into paragraphs
(ended by a line feed) and those into phrases (ended by ``. , ; : ! ?`` or
after 64 code points); every code point lies in exactly one of each. The hash
of a phrase covers its text, that of a paragraph its phrases' hashes, that of
a section its paragraphs', the root its sections'. So equal roots mean equal
texts, and a branch whose hash also stands in the other tree need not be
looked into: ``differences`` walks down differing branches only.

A fingerprint is that tree as a string::

    root(64 hex) { /section(16 hex) { ;paragraph(16 hex)+code points { .phrase(8 hex) } } }

Everything is a SQL expression over strings and arrays; there is no Python on
the data path.

Defined results: a null text is an empty one; the empty text has a root and
no branches, and all empty texts are alike. Rows with equal doc_id and equal
text are repeats of one document: each gets that document's row. The order of
documents is by doc_id, rows without one first, then by hashes of the text;
the next of the last is the first, and a document alone is its own next.
Columns other than doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.tables import land

SECTION = r"(?s).+?\n[ \t\r]*\n|.+"
PARAGRAPH = r"[^\n]*\n|[^\n]+"
PHRASE = r"[^.,;:!?]{1,64}[.,;:!?]*|[.,;:!?]+"


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.transform(F.array(value), fn)[0]


def _pieces(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _paragraph(text: Column) -> Column:
    """The hash of a paragraph and its part of the fingerprint."""
    phrases = F.array_join(F.transform(_pieces(text, PHRASE), _md5), "")
    return _let(phrases, lambda hs: _let(_md5(hs), lambda own: F.struct(own.alias("own"), F.concat(
        F.lit(";"), F.substring(own, 1, 16), F.lit("+"), F.char_length(text).cast("string"),
        F.regexp_replace(hs, "([0-9a-f]{8})[0-9a-f]{24}", ".$1")).alias("part"))))


def _section(text: Column) -> Column:
    """The hash of a section and its part of the fingerprint."""
    return _let(F.transform(_pieces(text, PARAGRAPH), _paragraph), lambda ps: _let(
        _md5(F.array_join(ps["own"], "")), lambda own: F.struct(own.alias("own"), F.concat(
            F.lit("/"), F.substring(own, 1, 16), F.array_join(ps["part"], "")).alias("part"))))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""
    return _let(F.transform(_pieces(F.coalesce(text, F.lit("")), SECTION), _section), lambda ss: F.concat(
        F.sha2(F.array_join(ss["own"], "").cast("binary"), 256), F.array_join(ss["part"], "")))


def root(fp: Column) -> Column:
    """The root hash; texts are equal where their roots are."""
    return F.substring(fp, 1, 64)


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, 0 to 1: 1 for equal roots only.

    The share of nodes that both have, where the nodes of a tree are its root
    and its distinct phrases (twice the shared ones over all).
    """
    def nodes(fp: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(fp, F.lit("[.]([0-9a-f]{8})"), F.lit(1)))
    shared = _let(F.struct(nodes(a).alias("a"), nodes(b).alias("b")), lambda n: (
        F.lit(2.0) * F.size(F.array_intersect(n["a"], n["b"])) / (F.size(n["a"]) + F.size(n["b"]) + 2)))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(shared)


def differences(a: Column, b: Column) -> Column:
    """The paragraphs of ``b`` that ``a`` lacks: an array of (start, chars) in code points of b's text, in order.

    Equal roots give an empty array. Sections whose hash also stands in ``a``
    are passed over whole; in the others those paragraphs count whose hash
    stands nowhere in ``a``.
    """
    none = F.array().cast("array<struct<start:long,chars:long>>")

    def hashes(fp: Column, mark: str) -> Column:
        return F.regexp_extract_all(fp, F.lit(mark + "([0-9a-f]{16})"), F.lit(1))

    def walk(new: Column) -> Column:
        rows = F.flatten(F.transform(F.regexp_extract_all(b, F.lit("/([^/]+)"), F.lit(1)), lambda s: _let(
            F.array_contains(new["sections"], F.substring(s, 1, 16)), lambda differs: F.transform(
                F.regexp_extract_all(s, F.lit(";([0-9a-f]{16}[+][0-9]+)"), F.lit(1)), lambda p: F.struct(
                    F.substring_index(p, "+", -1).cast("long").alias("chars"),
                    (differs & F.array_contains(new["paragraphs"], F.substring(p, 1, 16))).alias("new"))))))
        return F.aggregate(
            rows, F.struct(F.lit(0).cast("long").alias("at"), none.alias("found")),
            lambda acc, r: F.struct(
                (acc["at"] + r["chars"]).alias("at"),
                F.when(r["new"], F.concat(acc["found"], F.array(F.struct(
                    acc["at"].alias("start"), r["chars"].alias("chars"))))).otherwise(acc["found"]).alias("found")),
            lambda acc: acc["found"])
    new = F.struct(F.array_except(hashes(b, "/"), hashes(a, "/")).alias("sections"),
                   F.array_except(hashes(b, ";"), hashes(a, ";")).alias("paragraphs"))
    return F.when(root(a) == root(b), none).otherwise(_let(new, walk))


KEY = ["has_id", "id", "h1", "h2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty) under a key without nulls: doc_id and two hashes of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        F.col("doc_id").isNotNull().alias("has_id"), F.coalesce("doc_id", F.lit(0).cast(id_kind)).alias("id"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), text.alias("text"))


def keys_before(keys: DataFrame) -> DataFrame:
    """Each key with that of the document before it (``prev_*``) and that one's code points (``prev_chars``).

    ``keys`` holds ``KEY`` and n_chars, a row per document. They are dealt to
    sorted ranges; inside a range the row before comes from a window, and the
    first row of a range takes the last row of the range before, from a table
    of one row a range.
    """
    ordered = land(keys.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "order")
    me = F.struct(*KEY, "n_chars")
    inside = ordered.withColumn("before", F.lag(me).over(Window.partitionBy("part").orderBy(*KEY)))
    ranges = ordered.groupBy("part").agg(F.max(me).alias("last"))
    around = Window.orderBy("part")
    ranges = ranges.select("part", F.coalesce(F.lag("last").over(around), F.last("last").over(
        around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("last"))
    placed = inside.join(ranges, "part").withColumn("before", F.coalesce("before", "last"))
    return placed.select(*KEY, *[F.col(f"before.{k}").alias(f"prev_{k}") for k in KEY],
                         F.col("before.n_chars").alias("prev_chars"))


def pack_nodes(fp: Column) -> Column:
    """The root and phrase hashes of a fingerprint as bytes, an eighth of its text's size or less."""
    return F.unhex(F.regexp_replace(fp, "[/;][0-9a-f]{16}([+][0-9]+)?|[.]", ""))


def unpack_nodes(packed: Column) -> Column:
    """A fingerprint without sections and paragraphs, enough for ``likeness``."""
    return _let(F.lower(F.hex(packed)), lambda h: F.concat(
        root(h), F.regexp_replace(F.substr(h, F.lit(65)),
                                  "([0-9a-f]{8})", ".$1")))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_start and next_nodes of each row.

    ``next_start`` is the part of the next document's text that ``edited``
    needs, ``next_nodes`` its packed fingerprint. Repeats of a row are counted
    before the exchange and written out again at the end. Texts go through one
    exchange, which both joins read; only starts and nodes go through another.
    """
    once = (_keyed(docs).groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
            # keeps the count in both uses, so that they share the exchange
            .where("copies > 0"))
    keys = _keyed(docs).select(*KEY, F.char_length("text").cast("long").alias("n_chars")).distinct()
    sent = once.join(keys_before(keys).hint("merge"), KEY).select(
        *[F.col(f"prev_{k}").alias(k) for k in KEY],
        F.expr("substring(text, 1, cast(prev_chars div 4 as int))").alias("next_start"),
        pack_nodes(fingerprint(F.col("text"))).alias("next_nodes"))
    rows = once.join(sent.hint("merge"), KEY).withColumn("copy", F.expr("explode(sequence(1L, copies))"))
    return rows.select(F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "text", "next_start", "next_nodes")


def edited(text: Column, next_start: Column) -> Column:
    """The text, its last quarter (rounded down, in code points) replaced by the start of the next one."""
    n = F.char_length(text)
    return F.concat(F.substring(text, F.lit(1), n - F.floor(n / 4).cast("int")), next_start)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per row: the fingerprints of its text and of its edited text, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; see the module for odd rows.
    """
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_start")))
    rows = (rows.withColumn("fingerprint", fingerprint(F.col("text")))
            .withColumn("edited_fingerprint", fingerprint(F.col("edited")))
            .withColumn("next_fingerprint", unpack_nodes(F.col("next_nodes"))))
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
