"""Language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: how many of
the byte 1- to 4-grams that occur in one occur in the other too, over the
geometric mean of their numbers. Random texts of the training sample are the
Nystroem landmarks; one-versus-rest kernel ridge regression over the kernel
values against them gives a weight per landmark and language. Both steps are
linear, so the landmark sums are folded once into one column per language, and
a text's values are the sums of the columns' entries at its grams.

A text is read in equal pieces of at most ``PIECE`` bytes and has the mean of
their values, so a presence row holds about as many grams as those of the fit,
however long the text is.

Presence rows hash grams to a fixed number of columns and are kept as lists of
those set, so memory is bounded by the batch. The fit takes at most ``SAMPLE`` labelled texts, those with the
least hash of their key, a bound that does not grow with the corpus.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.tables import keyed_join, map_texts

SAMPLE = 2000           # labelled texts for the fit, whole, of at most SAMPLE_CHARS characters each
LANG_ROWS = 20          # of each language at least, where it has so many
SAMPLE_CHARS = 20_000
LANDMARKS = 200
COLUMNS = 1 << 17       # a piece sets a fraction of them
PIECE = 20_000
GRAMS = 4
RIDGE = 1e-2
_LETTER = re.compile(r"[^\W\d_]")
_STEP = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))


def presence(raw: list[bytes]) -> list[np.ndarray]:
    """Which hashed grams of each piece occur, as distinct columns."""
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint32)
    h = np.zeros(len(buf), dtype=np.uint32)
    shift = np.uint32(32 - COLUMNS.bit_length() + 1)
    columns = []
    for n in range(GRAMS):
        h = h[:len(buf) - n] + (buf[n:] + np.uint32(1)) * _STEP[n]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39) + np.uint32(n)
        columns.append((mixed >> shift).astype(np.int64))
    seen = np.zeros(COLUMNS, dtype=np.int64)
    out, a = [], 0
    for r in raw:
        b = a + len(r)
        at = np.concatenate([c[a:max(a, b - n)] for n, c in enumerate(columns)])
        turn = np.arange(len(at))
        seen[at] = turn                     # the last place of each column stays
        out.append(at[seen[at] == turn])
        a = b
    return out


def pieces(text: str | None) -> list[bytes]:
    """The lower-cased text in equal pieces that share ``GRAMS`` - 1 bytes, so that no gram is lost."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // PIECE))
    cuts = [len(raw) * k // n for k in range(n + 1)]
    return [raw[a:b + GRAMS - 1] for a, b in zip(cuts[:-1], cuts[1:])]


def fit(texts: list[str], langs: list[str], seed: int = 7):
    """(languages, one column of folded weights each) by ridge regression on the landmarks' kernels."""
    names = sorted(set(langs))
    rows = presence([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    picked = np.random.Generator(np.random.PCG64(seed)).permutation(len(texts))[:LANDMARKS]
    marks = np.zeros((COLUMNS, len(picked)), dtype=np.float32)
    for j, k in enumerate(picked):
        marks[rows[k], j] = 1 / np.sqrt(max(len(rows[k]), 1))
    k_nm = np.array([marks[r].sum(axis=0) / np.sqrt(max(len(r), 1)) for r in rows], dtype=np.float64)
    k_mm = k_nm[picked]
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    solve = k_nm.T @ k_nm + RIDGE * len(texts) / 100 * (k_mm + 1e-6 * np.eye(len(picked)))
    beta = np.linalg.solve(solve, k_nm.T @ y)
    return names, (marks @ beta.astype(np.float32))


def predict(texts: list[str | None], names: list[str], folded: np.ndarray) -> tuple[list[str], np.ndarray]:
    cut = [pieces(t) for t in texts]
    rows = presence([p for c in cut for p in c])
    values = np.array([folded[r].sum(axis=0) / np.sqrt(max(len(r), 1)) for r in rows]).reshape(len(rows), len(names))
    sizes = np.array([len(c) for c in cut], dtype=np.int64)
    values = np.add.reduceat(values, np.cumsum(sizes) - sizes) / sizes[:, None] if len(texts) else values
    best = values.argmax(axis=1)
    score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1).astype(np.float64)
    blank = np.array([not (t and _LETTER.search(t)) for t in texts])
    return ["und" if b else names[k] for b, k in zip(blank.tolist(), best.tolist())], np.where(blank, 0.0, score)


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """Fit on the at most ``SAMPLE`` texts of ``labelled`` whose key has the least hash.

    Of a language with fewer than ``LANG_ROWS`` texts among them, the next ones
    join, so the sample is bounded by ``SAMPLE`` and ``LANG_ROWS`` for each
    language. It is chosen by key and language alone in a first job, so the
    sort carries no texts. Equal rows are sampled once; longer texts and rows
    without key, text, letters or language are not sampled; without any, the
    model is None.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    usable = usable.where((F.length(text) <= SAMPLE_CHARS)).withColumn(
        "place", F.struct(F.xxhash64(F.col(key).cast("string")), F.col(key), F.xxhash64(text, lang)))
    narrow = usable.select("place", F.col(lang).alias("l")).distinct()
    by_lang = Window.partitionBy("l").orderBy("place")
    first = narrow.withColumn("r", F.row_number().over(by_lang)).where(F.col("r") <= LANG_ROWS).select("place")
    chosen = narrow.orderBy("place").limit(SAMPLE).select("place").union(first).distinct()
    rows = (keyed_join(usable, chosen, "place", "left_semi")
            .select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).distinct().collect())
    rows = sorted(r for r in rows if _LETTER.search(r["t"]))
    return fit([r["t"] for r in rows], [r["l"] for r in rows]) if rows else None


def identify(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row, from its whole text alone.

    A text that is null or has no letter, or any text without a model, is
    ``und`` with score 0. Repeated rows repeat; an empty table gives an empty
    result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # COLUMNS x languages numbers

    def run(keys, texts):
        if shared.value is None:
            return [keys, ["und"] * len(texts), np.zeros(len(texts))]
        return [keys, *predict(texts, *shared.value)]

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text, run,
                     f"{key} long, lang_pred string, score double", batch_bytes=1 << 20)
