"""Python workers: one a task in packing, and what a chunk or a bucket takes in between."""

import tracemalloc

import numpy as np
import pyarrow as pa

from eventweave.llm import ngram_join, packing, words
from eventweave.llm.tables import arrow_schema


def _peak(fn):
    """(result, bytes held at most meanwhile)."""
    tracemalloc.start()
    try:
        return fn(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_digests_take_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "one two three " * 900), (2, None), (3, ""), (None, "four")], "doc_id long, text string")
    out = packing.digests(docs)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    crc = {(r.doc_id, r.start): packing.zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes())
           for r in packing.pack(docs).collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in out.collect()} == crc and len(crc) > 4


def test_word_hashes_take_little_more_than_the_text():
    texts = [b"some words  of\tall lengths " * 20_000, b"", b"x" * 1_500_000, b" end", "é漢".encode() * 1000 + b" a"]
    (got, first), peak = _peak(lambda: words.word_hashes(texts * 2))
    alone = np.concatenate([words.word_hashes([t])[0] for t in texts * 2])
    one_by_one = {w: words.word_hashes([w])[0][0] for w in set(b" ".join(texts).split())}
    assert (got == alone).all() and first[-1] == len(got)
    assert got.tolist() == [one_by_one[w] for w in b" ".join(texts * 2).split()]
    _, peak = _peak(lambda: words.word_hashes([texts[0] * 8]))
    assert peak < 25 * len(texts[0]) * 8


def test_bucket_is_counted_in_little_memory():
    schema = arrow_schema(ngram_join._COUNTED)
    rng = np.random.Generator(np.random.PCG64(5))
    rows, want = [], {}
    for chunk in range(20):
        tok = np.unique(rng.integers(0, 1 << 36, 60_000, dtype=np.uint64))
        tok[:3] = [7, 8, 9 + chunk]                 # 7 and 8 are in all chunks, 9 is pre-counted too
        many = np.array([8 + (1 << 37), 9 + (1 << 38), 9], dtype=np.uint64)[chunk % 3:chunk % 3 + 1]
        times = np.array([2 + chunk], dtype=np.uint32)
        for t in tok.tolist():
            want[t] = want.get(t, 0) + 1
        want[int(many[0])] = want.get(int(many[0]), 0) + int(times[0])
        rows.append({"bucket": 0, "chunk": chunk, "tok": tok.astype(np.uint32).tobytes(),
                     "top": (tok >> np.uint64(32)).astype(np.uint8).tobytes(),
                     "doc": np.zeros(len(tok), np.uint16).tobytes(), "many": many.tobytes(), "many_n": times.tobytes()})
    table = pa.Table.from_pylist(rows, schema=arrow_schema(ngram_join._PACKED))
    out, peak = _peak(lambda: ngram_join._counter(schema)(table))
    assert out.num_rows == 20
    for r in out.to_pylist():
        for tok, df in (("tok", "df"), ("many", "many_df")):
            got = dict(zip(np.frombuffer(r[tok], np.uint64).tolist(), np.frombuffer(r[df], np.uint32).tolist()))
            assert got == {t: want[t] for t in got}
    found = {t for r in out.to_pylist() for t in np.frombuffer(r["tok"], np.uint64).tolist()}
    assert {t for t in found if want[t] > 1} == found and {7, 8} <= found
    assert peak < 24 * 20 * 60_000                  # bytes for each token
