"""Packing: tokenize, concatenate, and cut into fixed windows.

Pass one tokenizes every text once and lands its ids with the running token
count of its partition. The partitions' totals, one number each, are summed
to offsets. Pass two needs no order and no shuffle: a document's place in the
whole stream is its partition's offset plus its running count, so it cuts
itself at the window borders. A window that two partitions share is made of
boundary records from both; ``sequences`` joins any window's pieces by its
number. Only the very last window is padded.

The encoder is exact and works on words: a text is cut at the strings of the
vocabulary's added tokens, which are one id each wherever they stand. What lies
between is split before each single space that a character other than white
space follows, where the tokenizer's own pre-splitting always breaks, and every
distinct word of a partition is encoded once while it stays in a bounded cache.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import arrow_schema, give_back, land, scratch_root

LENGTH = 1024
CACHE_WORDS = 300_000

# The added tokens of the default vocabulary and their ids.
ADDED = {"<|endoftext|>": 50256}

_GAP = re.compile(r" (?=\S)")
_ODD = re.compile(r" \s| $")


class Encoder:
    """Ids of a byte-level BPE vocabulary given as ranks, as little-endian 16-bit numbers."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        added = ADDED if added is None else added
        if max([*ranks.values(), *added.values()]) >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self._encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self._known: dict[str, bytes] = {}
        self._added = {t: np.array([i], dtype="<u2").tobytes() for t, i in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(longest_first) + ")").split if added else lambda text: [text]

    def _ids(self, text: str) -> bytes:
        return np.array(self._encode(text), dtype="<u2").tobytes()

    def __call__(self, text: str) -> bytes:
        if not any(t in text for t in self._added):
            return self._plain(text)
        return b"".join(self._added.get(part) or self._plain(part) for part in self._cut(text) if part)

    def _plain(self, text: str) -> bytes:
        words = _GAP.split(text) if _ODD.search(text) else text.split(" ")
        known, head = self._known, self._ids(words[0])
        try:
            return head + b"".join([known[w] for w in words[1:]])
        except KeyError:
            pass
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words[1:]:
            if w not in known:
                known[w] = self._ids(" " + w)
        return head + b"".join([known[w] for w in words[1:]])


def tokenizer_files() -> tuple[str, str]:
    """The default vocabulary (the ranks of byte_bpe_50k.json) and its pre-splitting pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _tokenized(docs: DataFrame, key: str, text: str, end_id: int, files) -> DataFrame:
    ending = np.array([end_id], dtype="<u2").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        encode = Encoder(*(files or tokenizer_files()))
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = batch.slice(a, 500)
                ids = [(encode(t) if (t := v.as_py()) else b"") + ending for v in rows.column(1)]
                n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(ids), part, dtype=np.int64)), pa.array(starts),
                     pa.array(n), pa.array(ids, pa.binary())], names=["doc_id", "part", "before", "n", "ids"])
        del encode
        give_back()

    scratch_root(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, part long, before long, n long, ids binary")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         end_id: int = 0, files: tuple | None = None) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece.

    Each text's ids are followed by ``end_id``; ``ids`` has a piece's ids as
    little-endian 16-bit numbers. A null or empty text is its end alone.
    Repeated rows are packed each; a null key stays null; an empty table gives
    an empty result; other columns are not read. ``files`` is a vocabulary of
    ranks, a pre-splitting pattern and, if it has other added tokens than the
    default one, their ids.
    """
    return _pieces(docs, key, text, length, end_id, files, ("ids", "binary"), lambda ids: ids)


def _pieces(docs: DataFrame, key: str, text: str, length: int, end_id: int, files: tuple | None,
            content: tuple[str, str], of) -> DataFrame:
    """The pieces; in place of ``ids`` stands the column ``content`` (name, type), which ``of`` makes of a piece's ids.

    It is made where the pieces are cut: a second function behind would be a second worker for each task.
    """
    held = land(_tokenized(docs, key, text, end_id, files), "ids")
    totals = {r["part"]: r["n"] for r in held.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    offsets, at = {}, 0            # one number for each partition of the input
    for part in sorted(totals):
        offsets[part] = at
        at += totals[part]
    shared = held.sparkSession.sparkContext.broadcast(offsets)

    def cut(batches):
        import pyarrow as pa
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                rows = batch.slice(a, 200)
                doc, part, before, n = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(4))
                n = n.astype(np.int64)
                first = np.array([shared.value[int(p)] for p in part], dtype=np.int64) + before
                seq0 = first // length
                pieces = (first + n - 1) // length - seq0 + 1
                owner = np.repeat(np.arange(len(n)), pieces)
                turn = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                seq = seq0[owner] + turn
                lo = np.maximum(first[owner], seq * length)
                hi = np.minimum((first + n)[owner], (seq + 1) * length)
                start = lo - first[owner]
                raw = [v.as_buffer().to_pybytes() for v in rows.column(4)]
                ids = [raw[o][2 * s:2 * (s + m)] for o, s, m in
                       zip(owner.tolist(), start.tolist(), (hi - lo).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(owner)), pa.array(start), pa.array(hi - lo),
                     pa.array([of(x) for x in ids], kind), pa.array(n[owner]), pa.array(seq), pa.array(lo - seq * length)],
                    names=["doc_id", "start", "length", content[0], "doc_tokens", "sequence_id", "offset"])
        give_back()

    kind = arrow_schema(" ".join(content)).field(0).type
    return held.select("doc_id", "part", "before", "n", "ids").mapInArrow(
        cut, f"doc_id long, start long, length long, {' '.join(content)}, doc_tokens long, sequence_id long, "
             "offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the windows, whole, from their pieces."""
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.expr("aggregate(array_sort(collect_list(struct(offset, ids))), cast('' as binary), "
               "(a, p) -> concat(a, p.ids))").alias("ids"))      # at most `length` ids


def digests(docs: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids as little-endian 32-bit numbers."""
    return _pieces(docs, "doc_id", "text", LENGTH, 0, None, ("ids_crc32", "long"),
                   lambda ids: zlib.crc32(np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()))
