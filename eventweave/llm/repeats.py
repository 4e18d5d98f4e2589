"""Removal of repeated passages by prefix-free parsing.

Every byte covered by a string of ``DEPTH`` bytes that also starts anywhere
else is removed. A trigger is the least rolling hash among the first
``DEPTH / 2`` places of a string, so each string has exactly one, found from
its own bytes alone; neighbouring strings share theirs, and the triggers cut
the corpus into phrases. Strings of one trigger lie in one stretch, the
phrase before the trigger and the text after it, and all of them contain the
trigger's core, the ``DEPTH / 2`` bytes from it on. The dictionary is the set
of (core, stretch) pairs; the parse is the order in which documents use them.

1. One pass over the texts finds triggers and sends fingerprints of core and
   stretch, packed by chunks of documents, to hash buckets, where they are
   sorted. Pairs that repeat inside a chunk are counted there first, so a
   very common passage is one entry a chunk. A core that is used once has no
   repeated string; a stretch that is used twice is repeated in full. Only
   single stretches of a shared core stay open: the edges of repeats.
2. The dictionary entries of open cores, their bytes, meet by core. Their
   suffixes of ``DEPTH`` bytes are sorted by fingerprint, and those that are
   equal to a neighbour are repeated. A core with very many entries sends
   fingerprints of single suffixes instead, which Spark counts, so that no
   task holds all entries of a core.

Fingerprints have 64 bits; sorting by them in place of the bytes gives another
corpus order, in which equal suffixes are neighbours just the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import arrow_schema, land, scratch_root
from eventweave.llm.words import _BYTE_KEYS, mix64

DEPTH = 200
HALF = DEPTH // 2
GRAM = 16                   # bytes under the rolling hash
SEGMENT = 1 << 19           # bytes hashed at a time; longer texts go in overlapping segments
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 60_000
BUCKET_BYTES = 24 << 20     # text whose triggers share a hash bucket
HOT = 2000                  # entries of one core beyond which Spark counts single suffixes

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POW.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, SEGMENT + 2 * DEPTH), base, dtype=np.uint64)
        held[0] = 1
        held = _POW[base] = np.cumprod(held)
    return held[:n]


class Prints:
    """Fingerprints of any stretch of a buffer."""

    def __init__(self, buf: np.ndarray):
        self.total = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_KEYS[buf] * _powers(_BASE, len(buf)), out=self.total[1:])
        self.undo = _powers(_INVERSE, len(buf) + 1)

    def of(self, a, b):
        return (self.total[b] - self.total[a]) * self.undo[a]


def triggers(buf: np.ndarray, ends: np.ndarray):
    """(trigger, first start, last start, core print, stretch print) of each run of strings.

    ``ends`` holds, for each byte of ``buf``, the end of its text.
    """
    n = len(buf)
    if n < DEPTH:
        return [np.zeros(0, dtype=np.int64)] * 3 + [np.zeros(0, dtype=np.uint64)] * 2
    prints = Prints(buf)
    at = np.arange(n - GRAM + 1)
    roll = mix64(prints.of(slice(0, n - GRAM + 1), slice(GRAM, n + 1)))
    least = (roll & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width = 1
    while 2 * width <= HALF:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = HALF - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.flatnonzero(np.arange(n - DEPTH + 1) + DEPTH <= ends[:n - DEPTH + 1])
    if not len(starts):
        return [np.zeros(0, dtype=np.int64)] * 3 + [np.zeros(0, dtype=np.uint64)] * 2
    own = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    p, s = own[new], starts[new]
    e = starts[np.append(new[1:], len(starts)) - 1]
    core = mix64(prints.of(p, p + HALF))
    stretch = mix64(prints.of(s, e + DEPTH) + (p - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                    + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return p, s, e, core, stretch


def _segments(texts: list[bytes]):
    """(buffer, end of each byte's text, text number, place in its text) in parts of about ``SEGMENT`` bytes."""
    held, size = [], 0
    for d, t in enumerate(texts):
        for a in range(0, max(1, len(t) - DEPTH + 1), SEGMENT):
            part = t[a:a + SEGMENT + DEPTH - 1]
            if len(part) >= DEPTH:
                if held and size + len(part) > SEGMENT + DEPTH:
                    yield held
                    held, size = [], 0
                held.append((d, a, part))
                size += len(part)
    if held:
        yield held


def find_triggers(texts: list[bytes]):
    """(text number, trigger, first start, last start, core, stretch), places within each text."""
    out = []
    for held in _segments(texts):
        buf = np.frombuffer(b"".join(p for _, _, p in held), dtype=np.uint8)
        lens = np.array([len(p) for _, _, p in held])
        begin = np.cumsum(lens) - lens
        p, s, e, core, stretch = triggers(buf, np.repeat(begin + lens, lens))
        k = np.searchsorted(begin, s, side="right") - 1
        move = np.array([a for _, a, _ in held])[k] - begin[k]
        out.append((np.array([d for d, _, _ in held])[k], p + move, s + move, e + move, core, stretch))
    if not out:
        return [np.zeros(0, dtype=np.int64)] * 4 + [np.zeros(0, dtype=np.uint64)] * 2
    return [np.concatenate(c) for c in zip(*out)]


_PACKED = ("bucket long, chunk long, core binary, stretch binary, ref binary, "
           "many_core binary, many_stretch binary, many_ref binary, "
           "ids binary, marks binary, doc binary, place binary, first_n binary, last_n binary, "
           "local_ref binary, local_at binary")
_FOUND = ("chunk long, ref binary, state binary, many_ref binary, many_state binary, "
          "ids binary, marks binary, doc binary, place binary, first_n binary, last_n binary, "
          "local_ref binary, local_at binary")
_HEAD = ("ids", "marks", "doc", "place", "first_n", "last_n", "local_ref", "local_at")
_FLAGGED = "doc_id long, mark long, place binary, first_n binary, last_n binary, state binary"
REPEATED, OPEN, WITNESS = 1, 2, 4


def _pack(ids, marks, texts, chunk: int, buckets: int) -> list[dict]:
    doc, p, s, e, core, stretch = find_triggers(texts)
    order = np.lexsort((stretch, core, core % np.uint64(buckets)))
    core, stretch = core[order], stretch[order]
    new = np.concatenate([[True], (core[1:] != core[:-1]) | (stretch[1:] != stretch[:-1])]) if len(core) else order > 0
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(core)))
    single, many = first[times == 1], first[times > 1]
    often = np.repeat(times, times) > 1
    group = np.repeat(np.cumsum(times > 1) - 1, times)
    rows = [{"bucket": -1 - chunk, "chunk": chunk, "ids": np.array(ids, dtype=np.int64).tobytes(),
             "marks": np.array(marks, dtype=np.int64).tobytes(), "doc": doc.astype(np.uint16).tobytes(),
             "place": p.astype(np.uint32).tobytes(), "first_n": (p - s).astype(np.uint8).tobytes(),
             "last_n": (p - e).astype(np.uint8).tobytes(),
             "local_ref": group[often].astype(np.uint32).tobytes(),
             "local_at": order[often].astype(np.uint32).tobytes()}]
    at_single, at_many = core[single] % np.uint64(buckets), core[many] % np.uint64(buckets)
    present = np.union1d(at_single, at_many)                # the buckets that have entries
    sides = [(np.searchsorted(at, present, side="left"), np.searchsorted(at, present, side="right"))
             for at in (at_single, at_many)]
    for k, x0, x1, y0, y1 in zip(present.tolist(), *sides[0], *sides[1]):
        x, y = single[x0:x1], many[y0:y1]
        rows.append({"bucket": k, "chunk": chunk, "core": core[x].tobytes(), "stretch": stretch[x].tobytes(),
                     "ref": order[x].astype(np.uint32).tobytes(), "many_core": core[y].tobytes(),
                     "many_stretch": stretch[y].tobytes(), "many_ref": np.arange(y0, y1, dtype=np.uint32).tobytes()})
    return rows


def _packer(buckets: int):
    schema = arrow_schema(_PACKED)

    def pack(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        ids, marks, texts, held = [], [], [], 0
        for batch in batches:
            for i, m, t in zip(*(batch.column(k) for k in range(3))):
                text = t.as_py()
                if text is None or len(text) * 4 < DEPTH:
                    continue
                text = text.encode("utf-8", "surrogatepass")
                if ids and (held + len(text) > CHUNK_BYTES or len(ids) >= CHUNK_DOCS):
                    yield pa.RecordBatch.from_pylist(_pack(ids, marks, texts, chunk, buckets), schema=schema)
                    ids, marks, texts, held, chunk = [], [], [], 0, chunk + 1
                ids.append(i.as_py())
                marks.append(m.as_py())
                texts.append(text)
                held += len(text)
        if ids:
            yield pa.RecordBatch.from_pylist(_pack(ids, marks, texts, chunk, buckets), schema=schema)
    return pack


def _ints(value, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer() if value.is_valid else b"", dtype=kind)


def _judge(table: pa.Table) -> pa.Table:
    """States of one bucket's (core, stretch) entries; a chunk's header passes through."""
    schema = arrow_schema(_FOUND)
    table = table.combine_chunks()
    if table["bucket"][0].as_py() < 0:
        empty = pa.nulls(table.num_rows, pa.binary())
        return pa.table([table[f.name] if f.name in _HEAD + ("chunk",) else empty for f in schema], schema=schema)
    parts = []
    for name in ("core", "many_core"):
        parts += [_ints(v, np.uint64) for v in table[name]]
    sizes = [len(x) for x in parts]
    core = np.concatenate(parts)
    stretch = np.concatenate([_ints(v, np.uint64) for name in ("stretch", "many_stretch") for v in table[name]])
    single = sum(sizes[:table.num_rows])
    weight = np.ones(len(core), dtype=np.int64)
    weight[single:] = 2                                  # at least two in their chunk
    order = np.lexsort((stretch, core))
    core, stretch, weight = core[order], stretch[order], weight[order]
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new = new_core.copy()
    new[1:] |= stretch[1:] != stretch[:-1]
    at_core, at = np.flatnonzero(new_core), np.flatnonzero(new)
    used = np.add.reduceat(weight, at)                   # of each distinct pair
    pair = np.cumsum(new) - 1
    in_core = np.add.reduceat(new.astype(np.int64), at_core)[np.cumsum(new_core) - 1]      # pairs of its core
    state = np.zeros(len(core), dtype=np.uint8)
    state[used[pair] > 1] = REPEATED
    state[(used[pair] == 1) & (in_core > 1)] = OPEN
    # a repeated stretch whose core has single ones shows them its suffixes, once
    has_open = np.zeros(len(at_core), dtype=bool)
    np.logical_or.at(has_open, np.cumsum(new_core) - 1, state == OPEN)
    state[new & (state == REPEATED) & has_open[np.cumsum(new_core) - 1]] |= WITNESS
    back = np.zeros(len(core), dtype=np.uint8)
    back[order] = state
    cuts = np.cumsum([0, *sizes])
    rows = []
    n = table.num_rows
    for k, chunk in enumerate(table["chunk"].to_pylist()):
        own, local = back[cuts[k]:cuts[k + 1]], back[cuts[n + k]:cuts[n + k + 1]]
        keep, keep_local = own > 0, local > 0
        if keep.any() or keep_local.any():
            rows.append({"chunk": chunk, "ref": _ints(table["ref"][k], np.uint32)[keep].tobytes(),
                         "state": own[keep].tobytes(),
                         "many_ref": _ints(table["many_ref"][k], np.uint32)[keep_local].tobytes(),
                         "many_state": local[keep_local].tobytes()})
    return pa.Table.from_pylist(rows, schema=schema)


def _flag(table: pa.Table) -> pa.Table:
    """The documents of one chunk that have repeated or open strings, with those triggers."""
    table = table.combine_chunks()
    head = next(k for k, v in enumerate(table["ids"]) if v.is_valid)
    whole = lambda name, kind: np.concatenate([_ints(v, kind) for v in table[name]])
    of = lambda name, kind: _ints(table[name][head], kind)
    doc, place = of("doc", np.uint16), of("place", np.uint32)
    first_n, last_n = of("first_n", np.uint8), of("last_n", np.uint8)
    state = np.zeros(len(doc), dtype=np.uint8)
    state[whole("ref", np.uint32)] = whole("state", np.uint8)
    group, at = of("local_ref", np.uint32), of("local_at", np.uint32)
    if len(group):
        of_group = np.zeros(int(group.max()) + 1, dtype=np.uint8)
        of_group[whole("many_ref", np.uint32)] = whole("many_state", np.uint8)
        state[at] = of_group[group]
        again = np.concatenate([[False], group[1:] == group[:-1]])
        state[at[again]] &= ~np.uint8(WITNESS)
    ids, marks = of("ids", np.int64), of("marks", np.int64)
    keep = np.flatnonzero(state)
    keep = keep[np.argsort(doc[keep], kind="stable")]
    cuts = np.searchsorted(doc[keep], np.arange(len(ids) + 1))
    rows = []
    for d in np.flatnonzero(np.diff(cuts)).tolist():
        k = keep[cuts[d]:cuts[d + 1]]
        rows.append({"doc_id": int(ids[d]), "mark": int(marks[d]), "place": place[k].tobytes(),
                     "first_n": first_n[k].tobytes(), "last_n": last_n[k].tobytes(), "state": state[k].tobytes()})
    return pa.Table.from_pylist(rows, schema=arrow_schema(_FLAGGED))


def _joined_runs(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the strings from ``first`` to ``last`` cover."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), (last + DEPTH).tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _digest(text: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    kept, at = hashlib.sha256(), 0
    for a, b in runs:
        kept.update(text[at:a])
        at = b
    kept.update(text[at:])
    return len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest()


_LOOKED = ("doc_id long, mark long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "text string, first binary, last binary")
_FIRST = _LOOKED + ", entries array<struct<core:long,place:long,first_n:int,last_n:int,open:boolean,bytes:binary>>"


def _first_look(batches):
    """Documents without open strings are done; the others keep their text, all show their open cores' entries."""
    entry = arrow_schema("core long, place long, first_n int, last_n int, open boolean, bytes binary")
    schema = arrow_schema(_LOOKED).append(pa.field("entries", pa.list_(pa.struct(list(entry)))))
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            rows = []
            for r in batch.slice(a, 200).to_pylist():
                raw = (r["text"] or "").encode("utf-8", "surrogatepass")
                row = {"doc_id": r["doc_id"], "mark": r["mark"], "n_bytes": len(raw)}
                if r["state"] is None:
                    row |= dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), _digest(raw, [])))
                else:
                    state = np.bitwise_or.reduce([np.frombuffer(x, dtype=np.uint8) for x in r["state"]])
                    place = np.frombuffer(r["place"], dtype=np.uint32).astype(np.int64)
                    back, fore = (np.frombuffer(r[c], dtype=np.uint8).astype(np.int64) for c in ("first_n", "last_n"))
                    sure = state & REPEATED > 0
                    first, last = (place - back)[sure], (place - fore)[sure]
                    shown = np.flatnonzero(state & (OPEN | WITNESS))
                    row["entries"] = [
                        {"core": int.from_bytes(hashlib.blake2b(raw[place[k]:place[k] + HALF], digest_size=8).digest(),
                                                "little", signed=True),
                         "place": int(place[k]), "first_n": int(back[k]), "last_n": int(fore[k]),
                         "open": bool(state[k] & OPEN), "bytes": raw[place[k] - back[k]:place[k] - fore[k] + DEPTH]}
                        for k in shown.tolist()]
                    if (state & OPEN).any():
                        row |= {"text": r["text"], "first": first.tobytes(), "last": last.tobytes()}
                    else:
                        row |= dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"),
                                        _digest(raw, _joined_runs(first, last))))
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _suffixes(table: pa.Table | pa.RecordBatch):
    """(row, offset before the trigger, fingerprint with the core) of every suffix of the entries."""
    step = SEGMENT // (2 * DEPTH)
    parts = [_some_suffixes(table.slice(a, step)) for a in range(0, table.num_rows, step)]
    return (np.concatenate([r + k * step for k, (r, _, _) in enumerate(parts)]),
            np.concatenate([o for _, o, _ in parts]), np.concatenate([v for _, _, v in parts]))


def _some_suffixes(table):
    raw = [v.as_buffer() for v in table["bytes"]]
    lens = np.array([r.size for r in raw], dtype=np.int64)
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    begin = np.cumsum(lens) - lens
    back = np.array(table["first_n"].to_pylist(), dtype=np.int64)
    fore = np.array(table["last_n"].to_pylist(), dtype=np.int64)
    n = back - fore + 1
    row = np.repeat(np.arange(len(n)), n)
    turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    prints = Prints(buf)
    at = begin[row] + turn
    offset = back[row] - turn
    core = np.array(table["core"].to_pylist(), dtype=np.int64).view(np.uint64)
    value = mix64(prints.of(at, at + DEPTH) + core[row] + offset.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return row, offset, value


_STARTS = "doc_id long, mark long, starts binary"


def _starts(table, row, offset, hit) -> list[dict]:
    """The first bytes of the repeated suffixes, by document."""
    out = []
    place = np.array(table["place"].to_pylist(), dtype=np.int64)
    start = place[row] - offset
    row, start = row[hit], start[hit]
    cuts = np.searchsorted(row, np.arange(table.num_rows + 1))
    ids, marks = table["doc_id"].to_pylist(), table["mark"].to_pylist()
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        out.append({"doc_id": ids[k], "mark": marks[k], "starts": start[cuts[k]:cuts[k + 1]].tobytes()})
    return out


def _meet(table: pa.Table) -> pa.Table:
    """The repeated suffixes among the entries of a bucket of cores."""
    table = table.combine_chunks()
    row, offset, value = _suffixes(table)
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    hit = np.zeros(len(order), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    hit &= np.array(table["open"].to_pylist(), dtype=bool)[row]
    return pa.Table.from_pylist(_starts(table, row, offset, hit), schema=arrow_schema(_STARTS))


def _single_suffixes(batches):
    for batch in batches:
        row, offset, value = _suffixes(batch)
        place = np.array(batch["place"].to_pylist(), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(pa.array(row)), batch["mark"].take(pa.array(row)), pa.array(place[row] - offset),
             batch["open"].take(pa.array(row)), pa.array(value.view(np.int64))],
            names=["doc_id", "mark", "start", "open", "suffix"])


def _second_look(batches):
    for batch in batches:
        out = [[], [], [], []]
        for r in batch.to_pylist():
            first, last = (np.frombuffer(r[c], dtype=np.int64) for c in ("first", "last"))
            more = np.frombuffer(b"".join(r["starts"] or []), dtype=np.int64)
            runs = _joined_runs(np.concatenate([first, more]), np.concatenate([last, more]))
            for c, v in zip(out, _digest(r["text"].encode("utf-8", "surrogatepass"), runs)):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c[:]) if c else pa.array([], t) for c, t in zip(
            out, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Texts are judged as UTF-8 bytes on the input as it is; null counts as
    empty, and texts under ``DEPTH`` bytes stay whole. Rows that repeat each
    other are repeats. Several rows may share a key, also a null one; an empty
    table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch_root(spark)
    src = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("mark"),
                      F.col(text).cast("string").alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(16, size // BUCKET_BYTES))
    found = (src.where(F.octet_length("text") >= DEPTH)
             .select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "mark", "text")
             .mapInArrow(_packer(buckets), _PACKED)
             .groupBy("bucket").applyInArrow(_judge, _FOUND)
             .groupBy("chunk").applyInArrow(_flag, _FLAGGED))
    # equal rows have equal triggers; which of them is a witness may differ
    flagged = found.groupBy("doc_id", "mark").agg(
        F.first("place").alias("place"), F.first("first_n").alias("first_n"), F.first("last_n").alias("last_n"),
        F.collect_set("state").alias("state"))
    look = (src.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(flagged, ["doc_id", "mark"], "left")
            .select("doc_id", "mark", "text", "place", "first_n", "last_n", "state").mapInArrow(_first_look, _FIRST))
    look = land(look, "repeats")
    entries = (look.select("doc_id", "mark", F.explode("entries").alias("e")).select("doc_id", "mark", "e.*"))
    hot = entries.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("core")
    hot = land(hot, "hot-cores")
    groups = max(16, buckets)
    usual = (entries.join(hot, "core", "left_anti").withColumn("part", F.pmod(F.xxhash64("core"), F.lit(groups)))
             .groupBy("part").applyInArrow(lambda t: _meet(t), _STARTS))
    single = entries.join(hot, "core", "left_semi").select(
        "doc_id", "mark", "core", "place", "first_n", "last_n", "open", "bytes").mapInArrow(
        _single_suffixes, "doc_id long, mark long, start long, open boolean, suffix long")
    single = land(single, "suffixes")
    again = single.groupBy("suffix").agg(F.count("*").alias("n")).where("n > 1").select("suffix")
    more = (single.where("open").join(again, "suffix", "left_semi").select("doc_id", "mark", "start")
            .mapInArrow(_as_starts, _STARTS))
    starts = usual.union(more).groupBy("doc_id", "mark").agg(F.collect_list("starts").alias("starts"))
    rest = (look.where("kept_sha256 is null").select("doc_id", "mark", "text", "first", "last")
            .join(starts, ["doc_id", "mark"], "left").select("doc_id", "text", "first", "last", "starts")
            .mapInArrow(_second_look, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    done = look.where("kept_sha256 is not null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return done.union(rest).withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))


def _as_starts(batches):
    for batch in batches:
        raw = [int(v).to_bytes(8, "little", signed=True) for v in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())],
                                         names=["doc_id", "mark", "starts"])
