"""The filter audit against a brute-force version, with ids that come in any order."""

import itertools
import random
import re

from pyspark.sql import functions as F

from eventweave.llm import filter_audit as fa

COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley"]


def fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in (
        ("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text)))) if bad}


def brute_force(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least: dict[str, int] = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    rows = []
    for i, t, s in docs:
        bad = fails(t or "")
        if i is not None and i > least[t or ""]:
            bad.add("E")
        rows.append((s or "", bad, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        found = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                found[order, step] = (
                    len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone))
        shares = {f: sum(v[1] for (o, k), v in found.items() if o[k - 1] == f) for f in "ABCDE"}
        out += [(part, o, k, *v, shares[o[k - 1]]) for (o, k), v in found.items()]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.select(COLS).collect())


def write(df, folder, files):
    for k in range(files):
        df.where(F.col("file") == k).drop("file").coalesce(1).write.mode("append").parquet(folder)
    return folder


def some_docs():
    pick = random.Random(5)
    words = [f"w{k}" for k in range(90)]
    pool = [" ".join(pick.choices(words[:m], k=n)) + tail for n, m, tail in itertools.product(
        (3, 49, 50, 70), (2, 20, 90), ("", " 100%", " ABCDEFGHIJ KLMNOPQ RSTUV"))] + ["", " \t"]
    docs = [(i, pick.choice(pool), pick.choice(["a", "b", None])) for i in range(300)]
    docs += [(None, pool[0], "a"), (None, pool[0], "a"), (7, None, "b"), (8, pool[0], "a"), (8, pool[0], "a")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0)]
    return docs, labels


def test_audit_retracts(spark, tmp_path):
    docs, labels = some_docs()
    # large ids first: nearly every text's smallest id comes in a later micro-batch
    rows = [(*d, 3 - (0 if d[0] is None else d[0]) // 80) for d in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, file int").selectExpr(
        "*", "1 as key", "2 as mask", "'x' as part", "true as good", "5 as label_id")
    path = write(df, str(tmp_path / "documents.parquet"), 4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'k' as key")
    want = brute_force(docs, labels)
    assert result(fa.audit(spark, path, marks, 4)) == want
    assert result(fa.audit(spark, path, marks, 1)) == want


def test_audit_odd_rows(spark, tmp_path, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = str(tmp_path / "odd.parquet")
    odd_docs.coalesce(1).write.parquet(path)
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert result(fa.audit(spark, path, labels)) == brute_force(docs, [])
    empty = str(tmp_path / "none.parquet")
    no_docs.write.parquet(empty)
    assert fa.audit(spark, empty, labels).collect() == []


def test_a_text_counted_in_tasks():
    import pyarrow as pa
    rows = [(b"t", 2, "p", False, False, i) for i in (5, 3, 9, 3, None)] + [(b"u", 0, "p", True, False, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["k", "m", "p", "g", "t", "i"])
    out = [tuple(r.values()) for b in fa.count_in_task([batch]) for r in b.to_pylist()]
    assert out == [(b"t", 2, "p", False, False, 3, 2, 2, 1), (b"u", 0, "p", True, False, 1, 1, 0, 0)]


def test_least_id_takes_over(spark):
    schema = "key string, mask int, part string, good boolean, toxic boolean, id long, n long"
    held = spark.createDataFrame([("t", 2, "p", False, False, 12, 1), ("t", 2, "p", False, False, 9, 2),
                                  ("u", 0, "p", False, False, 1, 1)], schema)
    new = spark.createDataFrame([("t", 2, "q", True, False, 4, 1), ("t", 2, "p", False, False, 9, 1),
                                 ("u", 0, "p", False, False, 5, 3), ("v", 1, "p", False, False, 7, 1)], schema)
    got = {(r.key, r.id, r.n, r.old, r.id > r.least) for r in fa.judge(new, held).collect()}
    assert got == {("t", 4, 1, False, False), ("t", 9, 1, False, True), ("t", 9, 2, True, True),
                   ("u", 5, 3, False, True), ("v", 7, 1, False, False)}
