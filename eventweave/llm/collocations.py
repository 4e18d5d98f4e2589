"""Phrases whose words keep together, from weighted acyclic automata of n-gram counts.

Each task reads its texts, sorts the n-grams it counted and builds count
transducers of them, one per language and prefix range. A range holds the
phrases whose first two words hash into it, so that no frequent first word is
one task's work. The transducers of a range go to one task, which unites them
and sums their weights as they come, keeps the phrases found often enough and
builds the range's automaton. That is done for 1 and 2 words first. A longer
phrase cannot be more frequent than the pairs in it, so in the second pass
only 3- and 4-grams count whose every pair is in a bit map of the frequent
pairs; its size is fixed, and where it fills up it passes more, never less.
Their transducers are united with the automata of the first pass.

Candidates are read off the automata, and the counts of the parts of every
cut come from composing the sorted distinct parts of a range with that
range's automaton. The rest is joins and windows over candidates.

Defined results: a null text is an empty one, a null lang is ``und``. Repeated
rows count as often as they occur; doc_id is not read, so rows without one
count too. Texts without words add nothing; an empty table gives no rows.
Words are told apart within a task by 64-bit hashes, between tasks by their
bytes. Columns other than text and lang are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.automata import LONGEST, Automaton, Union, pack_keys, restrict, sum_equal, unpack_keys
from eventweave.llm.tables import arrow_schema, discard, land, scratch_root
from eventweave.llm.words import mix64, span_hashes, word_spans

LEAST = 30                  # a candidate occurs this often
COVERED_PERCENT = 80        # dropped if a longer candidate around it has this share of its occurrences
TOP = 2000
SHARD_BYTES = 16 << 20      # texts of a task that are counted together
SLICE_BYTES = 4 << 20
PAIR_BITS = 1 << 27         # of the bit map of frequent pairs: 16 MB

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_FIRST, _SECOND = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC2B2AE3D27D4EB4F)

PIECES = "lang string, part int, n_words long, automaton binary"
CUTS = ("lang string, phrase string, a long, words int, k int, first string, first_part int, rest string, "
        "rest_part int")


class _Words:
    """The words of texts of one language as hashes, with the number of the piece that each is in."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.known: dict[int, bytes] = {}
        self.n_pieces = 0

    def add(self, texts: list[bytes]) -> None:
        buf, starts, ends, _ = word_spans([t.translate(_LOWER) for t in texts], _APART)
        hashes = span_hashes(buf, starts, ends, _APART)
        pieces = np.cumsum(_BREAK[buf])[starts] + self.n_pieces
        self.n_pieces += int(_BREAK[buf].sum()) + 1
        raw = buf.tobytes()
        distinct, at = np.unique(hashes, return_index=True)
        for h, a, b in zip(distinct.tolist(), starts[at].tolist(), ends[at].tolist()):
            if h not in self.known:
                self.known[h] = raw[a:b]
        self.hashes.append(hashes)
        self.pieces.append(pieces)

    def numbered(self):
        """(distinct words in byte order, their hashes, the number of each word, its piece)."""
        hashes = np.concatenate(self.hashes)
        distinct, number = np.unique(hashes, return_inverse=True)
        words = [self.known[h] for h in distinct.tolist()]
        order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        return [words[k] for k in order.tolist()], distinct[order], rank[number], np.concatenate(self.pieces)


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little"))


def _pair_hash(first: np.ndarray, second: np.ndarray | None, seed: np.uint64) -> np.ndarray:
    """The hash of the first two words of phrases (of the only one where ``second`` is None)."""
    with np.errstate(over="ignore"):
        both = first * _FIRST + seed
        return mix64(both if second is None else both + second * _SECOND)


def _range_of(pair: np.ndarray, parts: int) -> np.ndarray:
    return ((pair >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _bit(pair: np.ndarray) -> np.ndarray:
    return (pair & np.uint64(PAIR_BITS - 1)).astype(np.int64)


def _prefix_ranges(rows: np.ndarray, hashes: np.ndarray, seed: np.uint64, parts: int) -> np.ndarray:
    """The prefix range of each phrase."""
    out = np.empty(len(rows), dtype=np.int64)
    one = rows[:, 1] < 0
    out[one] = _range_of(_pair_hash(hashes[rows[one, 0]], None, seed), parts)
    out[~one] = _range_of(_pair_hash(hashes[rows[~one, 0]], hashes[rows[~one, 1]], seed), parts)
    return out


def _short_grams(number: np.ndarray, piece: np.ndarray):
    """Keys and counts of the phrases of one and two words."""
    counts = np.bincount(number)
    used = np.flatnonzero(counts)
    joined = piece[1:] == piece[:-1]
    pairs, n = np.unique((number[:-1][joined].astype(np.uint64) << np.uint64(32)) | number[1:][joined].astype(np.uint64),
                         return_counts=True)
    rows = np.full((len(used) + len(pairs), LONGEST), -1, dtype=np.int64)
    rows[:len(used), 0] = used
    rows[len(used):, 0] = (pairs >> np.uint64(32)).astype(np.int64)
    rows[len(used):, 1] = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return sum_equal(*pack_keys(rows), np.concatenate([counts[used], n]))


def _long_grams(number: np.ndarray, piece: np.ndarray, frequent: np.ndarray):
    """Keys and counts of the phrases of three and four words all of whose pairs are frequent.

    ``frequent[i]``: words i and i + 1 are a pair that may be.
    """
    ok = (piece[1:] == piece[:-1]) & frequent
    three = np.flatnonzero(ok[:-1] & ok[1:])
    four = np.flatnonzero(ok[:-2] & ok[1:-1] & ok[2:])
    rows = np.full((len(three) + len(four), LONGEST), -1, dtype=np.int64)
    for d in range(3):
        rows[:len(three), d] = number[three + d]
    for d in range(4):
        rows[len(three):, d] = number[four + d]
    return sum_equal(*pack_keys(rows), np.ones(len(rows), dtype=np.int64))


def _shards(batches, parts: int, pairs: np.ndarray | None):
    """Count transducers of a task's texts, one per language and prefix range.

    Of one and two words, or, with the bit map ``pairs``, of three and four.
    """
    schema = arrow_schema(PIECES)
    held: dict[str, _Words] = {}
    size = 0

    def flush():
        for lang, words in held.items():
            names, hashes, number, piece = words.numbered()
            if not len(number):
                continue
            seed = _seed(lang)
            if pairs is None:
                high, low, counts = _short_grams(number, piece)
            else:
                by_place = hashes[number]
                bits = _bit(_pair_hash(by_place[:-1], by_place[1:], seed))
                high, low, counts = _long_grams(number, piece, (pairs[bits >> 3] >> (bits & 7)) & 1 == 1)
            rows = unpack_keys(high, low)
            at = _prefix_ranges(rows, hashes, seed, parts)
            # the phrases of a range stay sorted; numbers of 16 bits sort by radix
            order = np.argsort(at.astype(np.uint16) if parts < 1 << 16 else at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1)) if len(at) else []
            out, n_words = [], len(number)
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order[a:b]
                used, local = restrict(names, rows[mine])
                out.append((lang, int(at[mine[0]]), n_words, Automaton.build(used, local, counts[mine]).dump()))
                n_words = 0
            for a in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*out[a:a + 64]), schema)], schema=schema)
        held.clear()

    for batch in batches:
        sliced: dict[str, list[bytes]] = {}
        waiting = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sliced.setdefault(lang, []).append(text)
            waiting += len(text)
            if waiting > SLICE_BYTES:
                for name, texts in sliced.items():
                    held.setdefault(name, _Words()).add(texts)
                size, waiting, sliced = size + waiting, 0, {}
        for name, texts in sliced.items():
            held.setdefault(name, _Words()).add(texts)
        size += waiting
        if size > SHARD_BYTES:
            yield from flush()
            size = 0
    yield from flush()


def _unite(pieces: DataFrame, least: int) -> DataFrame:
    """One automaton per language and range: the union of its pieces, weights summed, the rarer phrases left out."""
    def unite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union, n_words = Union(), 0
        for batch in batches:
            n_words += sum(batch.column("n_words").to_pylist())
            for data in batch.column("automaton").to_pylist():
                union.add(Automaton.load(data))
        row = [key[0].as_py(), key[1].as_py(), n_words, union.result(least).dump()]
        yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, arrow_schema(PIECES))],
                                         schema=arrow_schema(PIECES))
    return land(pieces.groupBy("lang", "part").applyInArrow(unite, PIECES), "automata")


def _frequent_pairs(automata: DataFrame) -> np.ndarray:
    """The bit map of the pairs in the automata: ``PAIR_BITS`` bits, whatever their number."""
    def bits(batches):
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                automaton = Automaton.load(data)
                rows, _ = automaton.phrases()
                rows = rows[(rows[:, 1] >= 0) & (rows[:, 2] < 0)]
                hashes = _hashes(automaton.words)
                bit = _bit(_pair_hash(hashes[rows[:, 0]], hashes[rows[:, 1]], _seed(lang))).astype(np.uint64)
                cell, at = np.unique(bit >> np.uint64(6), return_inverse=True)
                value = np.zeros(len(cell), dtype=np.uint64)
                np.bitwise_or.at(value, at, np.uint64(1) << (bit & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(value.view(np.int64))],
                                                 names=["cell", "value"])
    cells = (automata.select("lang", "automaton").mapInArrow(bits, "cell long, value long")
             .groupBy("cell").agg(F.bit_or("value").alias("value")).toArrow())
    out = np.zeros(PAIR_BITS // 64, dtype=np.int64)
    out[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    return out.view(np.uint8)


def _hashes(words: list[bytes]) -> np.ndarray:
    buf, starts, ends, _ = word_spans(words, _APART)
    return span_hashes(buf, starts, ends, _APART)


def _cuts(automata: DataFrame, parts: int) -> DataFrame:
    """Every candidate of the automata with every cut of it: the two parts and their prefix ranges."""
    def cut(batches):
        schema = arrow_schema(CUTS)
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                automaton = Automaton.load(data)
                rows, counts = automaton.phrases()
                rows, counts = rows[rows[:, 1] >= 0], counts[rows[:, 1] >= 0]
                names = [w.decode("utf-8", "replace") for w in automaton.words]
                hashes, seed = _hashes(automaton.words), _seed(lang)
                length = (rows >= 0).sum(axis=1)
                for k in range(1, LONGEST):
                    for a in range(0, len(rows), 50_000):
                        some = np.flatnonzero(length[a:a + 50_000] > k) + a
                        if not len(some):
                            continue
                        first = np.where(np.arange(LONGEST) < k, rows[some], -1)
                        rest = np.full_like(first, -1)
                        rest[:, :LONGEST - k] = rows[some, k:]
                        spelled = [[names[i] for i in r if i >= 0] for r in rows[some].tolist()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip((
                            [lang] * len(some), [" ".join(w) for w in spelled], counts[some], length[some],
                            [k] * len(some), [" ".join(w[:k]) for w in spelled],
                            _prefix_ranges(first, hashes, seed, parts), [" ".join(w[k:]) for w in spelled],
                            _prefix_ranges(rest, hashes, seed, parts)), schema)], schema=schema)
    return land(automata.select("lang", "automaton").mapInArrow(cut, CUTS), "cuts")


def _compose(automata: DataFrame, asked: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the distinct phrases ``asked(lang, part, phrase)``: a walk through their range's automaton."""
    def walk(left, right):
        phrases = right.column("phrase").to_pylist()
        loaded = [Automaton.load(d) for d in left.column("automaton").to_pylist()]
        found = [sum(a.count(words) for a in loaded) for words in (p.encode().split(b" ") for p in phrases)]
        return pa.table({"lang": right.column("lang"), "phrase": right.column("phrase"),
                         "f": pa.array(found, pa.int64())})
    return (automata.select("lang", "part", "automaton").groupBy("lang", "part")
            .cogroup(asked.groupBy("lang", "part")).applyInArrow(walk, "lang string, phrase string, f long"))


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, parts: int | None = None) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the count of the phrase, ``l`` and ``r`` those of the two parts of
    its worst cut, ``n`` the words of the language and score
    floor(2000000 a / (l + r)). Phrases whose words stand in a longer candidate
    with at least ``COVERED_PERCENT`` of their count are left out. ``parts`` is
    the number of prefix ranges a language is dealt to (four per shuffle
    partition). Ties and odd rows as in the module's text and ``TOP`` order:
    score, a (both falling), phrase in byte order.
    """
    spark = docs.sparkSession
    scratch_root(spark)
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    short = _unite(texts.mapInArrow(lambda batches: _shards(batches, parts, None), PIECES), least)
    pairs = spark.sparkContext.broadcast(_frequent_pairs(short))
    long = texts.mapInArrow(lambda batches: _shards(batches, parts, pairs.value), PIECES)
    automata = _unite(long.withColumn("n_words", F.lit(0).cast("long")).union(short), least)
    discard(short)

    cuts = _cuts(automata, parts)
    asked = (cuts.select("lang", F.col("first_part").alias("part"), F.col("first").alias("phrase"))
             .union(cuts.select("lang", "rest_part", "rest")).distinct())
    counted = land(_compose(automata, asked), "parts")
    scored = (cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
              .select("lang", "phrase", "cut.*"))
    # a phrase inside a longer candidate is inside one that is a word longer and at least as frequent
    around = (cuts.where("k = words - 1 and k > 1").select("lang", F.col("first").alias("phrase"), "a")
              .union(cuts.where("k = 1 and words > 2").select("lang", "rest", "a"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact("longer") < COVERED_PERCENT * _exact("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = automata.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                       F.col("score").cast("long").alias("score"))
