"""Benchmark decontamination by template canonicalisation.

Words of texts and of benchmark items become canonical tokens: letters and
digits only, in lower case, with numbers, names (capitalised words inside a
sentence) and units replaced by a typed placeholder each. Windows of
``WINDOW`` tokens of both sides meet in a hash join; placeholders keep the
words they stand for as slots. So a question whose numbers or names were
changed still meets its item.

Windows that match along one diagonal (place in the text less place in the
item) are consistent when their slots are: a number, name or unit of the item
stands for the same word of the text throughout. Two values of the item may
become one. Windows that are verbatim copies clash with none. A text is
contaminated by an item when a maximal consistent run of a diagonal's windows,
one that no window before or behind it can join without a clash, covers at
least half of the item, or ``RUN`` tokens; what lies outside takes nothing from
it. ``leaks`` judges so; ``contaminated`` is the stricter form, which drops a
diagonal on which any two slots clash, either way round.
Items shorter than the window are one window of their own length.

A typed window needs ``LITERALS`` words that are not placeholders. Where a
window has fewer, the shortest stretch of ``LITERALS`` such words with all that
stands between them is a window too. Besides, every window meets its verbatim
copy by the hashes of its words themselves, so items of fewer than ``LITERALS``
words of their own match verbatim only; items of fewer than ``LITERALS`` tokens
say too little and match nothing.

How it runs: the windows of the items are distinct rows. Fixed-size bit maps
of their hashes, whatever the number of items, go to the tasks that read the
texts, and only windows found there leave the map; they meet the items in a
shuffle join, which is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import keyed_join, map_texts
from eventweave.llm.words import _BYTE_KEYS, _power_table, mix64, word_spans

WINDOW = 8
LITERALS = 5            # words in a typed window that are not placeholders; tokens in a verbatim one
RUN = 13
MAP_BITS = 1 << 22

# Units, as canonical tokens.
UNITS = ("mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl l s sec secs second seconds min mins minute minutes "
         "h hr hrs hour hours day days week weeks month months year years hz khz mhz ghz w kw mw v kv a ma j kj cal kcal "
         "pa kpa bar psi k c f usd eur gbp dollar dollars euro euros cent cents pound pounds percent meter meters metre "
         "metres kilometer kilometers gram grams kilogram kilograms liter liters litre litres inch inches foot feet mile "
         "miles ounce ounces degree degrees").split()
# Units that are words or letters of their own unless a number stands before them.
AMBIGUOUS = [u for u in UNITS if len(u) == 1 or u in ("a", "in")]

_KEEP = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_DIGIT = np.array([48 <= c <= 57 for c in range(256)])
_FOLD = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
_END = np.isin(np.arange(256), [ord(c) for c in ".!?:;|\"'#*%$&)"])
_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (0x1001, 0x2002, 0x3003))
_TURN = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VERBATIM, _WIDE = (np.uint64(k) for k in (0x4004 << 32, 0x5005 << 32))


def _token_hashes(words: list[str]) -> np.ndarray:
    return Tokens([" ".join(words)], typed=False).plain


class Tokens:
    """Canonical tokens of a batch of texts: hash, plain hash, placeholder, place in the text, first of each text."""

    def __init__(self, texts: list[str | None], typed: bool = True):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        buf, starts, ends, _ = word_spans(raw)
        begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
        empty = np.zeros(0, dtype=np.uint64)
        self.plain, self.hash, self.slot, self.first = empty, empty, np.zeros(0, bool), np.zeros(len(raw) + 1, np.int64)
        self.buf, self.starts, self.ends = buf, starts, ends
        if not len(starts):
            return
        keep = _KEEP[buf]
        word = np.repeat(np.arange(len(starts)), ends - starts)
        inside = np.zeros(len(buf), dtype=bool)
        inside[np.arange(int((ends - starts).sum())) + np.repeat(starts - np.cumsum(ends - starts) + (ends - starts), ends - starts)] = True
        kept = keep & inside
        at = np.flatnonzero(kept)
        owner = word[(np.cumsum(inside) - 1)[at]]
        new = np.flatnonzero(np.diff(owner, prepend=-1))
        if not len(new):
            return
        size = np.diff(np.append(new, len(at)))
        chars = _FOLD[buf[at]]
        # capital Latin letters with marks, two bytes in UTF-8, to small ones
        lead = np.concatenate([[0], buf[at][:-1]]) == 0xC3
        accent = lead & (chars >= 0x80) & (chars <= 0x9E) & (chars != 0x97)
        folded = np.where(accent, chars + np.uint8(32), chars).astype(np.uint8)
        power = _power_table(int(size.max()))
        turn = np.arange(len(at)) - np.repeat(new, size)
        self.plain = mix64(np.add.reduceat(_BYTE_KEYS[folded] * power[turn], new))
        self.starts, self.ends = starts[owner[new]], ends[owner[new]]
        self.first = np.searchsorted(self.starts, begins)
        if not typed:
            return
        digits = np.add.reduceat(_DIGIT[chars].astype(np.int64), new)
        head = at[new]
        capital = (buf[head] >= 65) & (buf[head] <= 90) | (buf[head] == 0xC3) & accent[np.minimum(new + 1, len(at) - 1)]
        after = np.zeros(len(new), dtype=bool)          # the first word after an end of sentence, line or text
        after[0] = True
        after[1:] = _END[buf[self.ends[:-1] - 1]] | (buf[self.ends[:-1]] == 10) | (buf[self.starts[1:] - 1] == 10)
        code = self.plain.copy()
        name = capital & ~after & (size > 1)
        code[name] = _NAME
        number = digits == size
        counted = np.zeros(len(new), dtype=bool)        # the words after a number of the same text
        counted[1:] = number[:-1]
        counted[self.first[:-1][self.first[:-1] < len(new)]] = False
        unit, ambiguous = _units()
        code[np.isin(self.plain, unit) & (counted | ~np.isin(self.plain, ambiguous))] = _UNIT
        code[number] = _NUMBER
        self.slot = code != self.plain
        self.hash = mix64(code)

    def word(self, k: int) -> str:
        return bytes(self.buf[self.starts[k]:self.ends[k]]).decode("utf-8", "replace").strip(".,;:!?\"'()[]#*%$&|")


_unit_hashes: list = []


def _units() -> list[np.ndarray]:
    if not _unit_hashes:
        _unit_hashes.extend([_token_hashes(UNITS), _token_hashes(AMBIGUOUS)])
    return _unit_hashes


def windows(tokens: Tokens, length: int, verbatim: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of the windows of ``length`` tokens inside one text.

    Typed windows are those with enough words of their own; verbatim ones are
    all of enough tokens, by the words themselves.
    """
    n = len(tokens.hash) - length + 1
    if n <= 0 or verbatim and length < LITERALS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        h = h * _TURN + (tokens.plain if verbatim else tokens.hash)[k:k + n]
    text = np.searchsorted(tokens.first, np.arange(len(tokens.hash)), side="right")
    good = text[:n] == text[length - 1:]
    if not verbatim:
        own = np.concatenate([[0], np.cumsum(~tokens.slot)])
        good &= own[length:] - own[:-length] >= LITERALS
    at = np.flatnonzero(good)
    return at, mix64(h[at] + np.uint64(length) + (_VERBATIM if verbatim else np.uint64(0)))


def wide_windows(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, hash, length) of the stretches from one word of its own to the ``LITERALS``-th, longer than a window.

    Their lengths add up to at most ``LITERALS`` times the tokens.
    """
    own = np.flatnonzero(~tokens.slot)
    a, b = own[:max(0, len(own) - LITERALS + 1)], own[LITERALS - 1:] + 1
    text = np.searchsorted(tokens.first, own, side="right")
    good = (b - a > WINDOW) & (text[:len(a)] == text[LITERALS - 1:])
    a, b = a[good], b[good]
    turn = np.full(len(tokens.hash) + 1, _TURN)
    turn[0] = 1
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(tokens.hash * np.cumprod(turn)[:-1])])
    back = np.full(len(tokens.hash) + 1, _BACK)
    back[0] = 1
    h = (sums[b] - sums[a]) * np.cumprod(back)[a]
    return a, mix64(h + (b - a).astype(np.uint64) + _WIDE), b - a


def _all_windows(tokens: Tokens, widths: list[int]):
    """(first token, hash, length, verbatim) arrays of every kind of window."""
    for width in widths:
        for verbatim in (False, True):
            at, h = windows(tokens, width, verbatim)
            yield at, h, np.full(len(at), width), verbatim
    yield *wide_windows(tokens), False


def _slots(tokens: Tokens, a: int, length: int) -> str:
    """The words at the placeholders of a window, joined by tabs."""
    return "\t".join(tokens.word(k) for k in range(a, a + length) if tokens.slot[k])


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, n_tokens, width, place, window, slots) of every window of the items."""
    def run(keys, texts):
        out = [[] for _ in range(6)]
        for i, t in zip(keys, texts):
            tok = Tokens([t])
            n = len(tok.hash)
            width = min(n, WINDOW)
            for at, h, long, verbatim in _all_windows(tok, [width]) if width else ():
                for a, v, m in zip(at.tolist(), h.view(np.int64).tolist(), long.tolist()):
                    for c, x in zip(out, (i, n, m, a, v, "" if verbatim else _slots(tok, a, m))):
                        c.append(x)
        return out

    return map_texts(benchmark.withColumn(key, F.col(key).cast("long")), key, text, run,
                     f"{key} long, n_tokens long, width long, place long, window long, slots string")


def _text_windows(docs: DataFrame, key: str, text: str, widths: list[int], maps) -> DataFrame:
    def run(keys, texts):
        out = [[] for _ in range(4)]
        one, two = maps.value
        tok = Tokens(texts)
        if not len(tok.hash):
            return out
        for at, h, long, verbatim in _all_windows(tok, widths):
            hit = one[(h & np.uint64(MAP_BITS - 1)).astype(np.int64)] & two[(h >> np.uint64(42)).astype(np.int64)]
            at, h, long = at[hit], h[hit], long[hit]
            owner = np.searchsorted(tok.first, at, side="right") - 1
            for c, v in zip(out, ([keys[o] for o in owner.tolist()], (at - tok.first[owner]).tolist(),
                                  h.view(np.int64).tolist(),
                                  ["" if verbatim else _slots(tok, a, m) for a, m in zip(at.tolist(), long.tolist())])):
                c.extend(v)
        return out

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text, run,
                     f"{key} long, at long, window long, found string", batch_bytes=1 << 20)


def _one_to_one(pairs):
    n = F.size(F.array_distinct(pairs))
    return ((F.size(F.array_distinct(F.transform(pairs, lambda p: p["i"]))) == n)
            & (F.size(F.array_distinct(F.transform(pairs, lambda p: p["d"]))) == n))


def best_run(windows: list[tuple[int, int, list | None]]) -> tuple[int, int, int]:
    """(place, windows, covered tokens) of the consistent run that covers most, the first of equal ones.

    ``windows``: (place, width, slot pairs of item and text) of one diagonal.
    A run is a stretch of windows in order of place; those that clash in
    themselves stand in none.
    """
    held: dict = {}                 # word of the item -> [word of the text, how many windows of the run say so]
    best, left, run = (0, 0, 0), 0, []

    def judge(best):
        end = covered = 0
        for place, width, _ in run[left:]:
            covered += max(0, place + width - max(end, place))
            end = max(end, place + width)
        found = (run[left][0], len({w[0] for w in run[left:]}), covered)
        return found if covered > best[2] else best

    for place, width, pairs in sorted(windows, key=lambda w: (w[0], w[1])):
        own: dict = {}
        if any(own.setdefault(i, d) != d for i, d in pairs or ()):
            continue
        if all(i == d for i, d in own.items()):
            own = {}
        if any(i in held and held[i][0] != d for i, d in own.items()):
            best = judge(best)
            while any(i in held and held[i][0] != d for i, d in own.items()):
                for i in run[left][2]:
                    held[i][1] -= 1
                    if not held[i][1]:
                        del held[i]
                left += 1
        for i, d in own.items():
            held.setdefault(i, [d, 0])[1] += 1
        run.append((place, width, own))
    return judge(best) if left < len(run) else best


def _best_runs(batches):
    import pyarrow as pa
    for batch in batches:
        key, item, diagonal, tokens, met = batch.columns
        found = [best_run([(w["place"], w["width"], [(p["i"], p["d"]) for p in w["pairs"]] if w["pairs"] else None)
                           for w in ws]) for ws in met.to_pylist()]
        at = [d + f[0] for d, f in zip(diagonal.to_pylist(), found)]
        yield pa.RecordBatch.from_arrays(
            [key, item, pa.array(at, pa.int64()), tokens, pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.int64())],
            names=["key", "item", "at", "n_tokens", "n_windows", "n_covered"])


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
          item: str = "item_id", item_text: str = "text", whole: bool = False) -> DataFrame:
    """(key, item_id, at, n_windows, n_covered, n_tokens): one row per text and item that leaked into it.

    ``at`` is the text's token where the best run begins; with ``whole``
    only diagonals without any clash count.
    Null, empty and wordless texts match nothing; rows without key or item
    number are left out; equal rows count once; either table may be empty;
    other columns are not read.
    """
    spark = docs.sparkSession
    items = item_windows(benchmark.where(F.col(item).isNotNull()), item, item_text).distinct().cache()
    # at most MAP_BITS numbers each, whatever the size of the benchmark
    low = items.select(F.col("window").bitwiseAND(MAP_BITS - 1).alias("b")).distinct().toPandas()["b"].to_numpy()
    high = items.select(F.shiftrightunsigned("window", 42).alias("b")).distinct().toPandas()["b"].to_numpy()
    one, two = np.zeros(MAP_BITS, dtype=bool), np.zeros(MAP_BITS, dtype=bool)
    one[low.astype(np.int64)], two[high.astype(np.int64)] = True, True
    widths = sorted(r[0] for r in items.select("width").where(F.col("width") <= WINDOW).distinct().collect())
    maps = spark.sparkContext.broadcast((one, two))
    found = _text_windows(docs.where(F.col(key).isNotNull()), key, text, widths, maps).distinct()
    pairs = F.arrays_zip(F.split("slots", "\t").alias("i"), F.split("found", "\t").alias("d"))
    met = (found.join(items, "window").withColumn("diagonal", F.col("at") - F.col("place"))
           .withColumn("pairs", F.when(F.length("slots") > 0, pairs)))
    lines = met.groupBy(F.col(key).alias("key"), F.col(item).cast("long").alias("item"), "diagonal").agg(
        F.first("n_tokens").alias("n_tokens"),
        F.collect_set(F.struct("place", "width", "pairs")).alias("met"),               # an item's windows
        *([F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("all_pairs")] if whole else []))
    if whole:
        lines = lines.where(_one_to_one("all_pairs"))
    lines = lines.select("key", "item", "diagonal", "n_tokens", "met").mapInArrow(
        _best_runs, "key long, item long, at long, n_tokens long, n_windows long, n_covered long")
    lines = (lines.where((F.col("n_covered") * 2 >= F.col("n_tokens")) | (F.col("n_covered") >= RUN))
             .withColumnsRenamed({"key": key, "item": item}))
    best = F.max_by(F.struct("at", "n_windows", "n_covered", "n_tokens"), F.struct("n_covered", -F.col("at")))
    return lines.groupBy(key, item).agg(best.alias("b")).select(key, item, "b.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``leaks`` without the diagonals on which any two slots clash."""
    return leaks(docs, benchmark, key, text, item, item_text, whole=True)


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` into which no item leaked, as they are.

    Rows are judged by their text, whatever their key: null keys and keys of
    several texts too.
    """
    row_key = next(name for k in range(len(docs.columns) + 1) if (name := f"row_key_{k}") not in docs.columns)
    rows = docs.withColumn(row_key, F.xxhash64(text))
    leaked = leaks(rows.select(row_key, text), benchmark, row_key, text).select(row_key).distinct()
    return keyed_join(rows, leaked, row_key, "left_anti").select(docs.columns)


__all__ = ["Tokens", "best_run", "clean", "contaminated", "item_windows", "leaks"]
