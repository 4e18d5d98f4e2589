"""Hash trees of texts against a version in plain Python."""

import hashlib
import re

from pyspark.sql import functions as F

from eventweave.llm import fingerprint as fp


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def tree(text):
    own, out = "", ""
    for section in re.findall(fp.SECTION, text):
        s_own, s_out = "", ""
        for paragraph in re.findall(fp.PARAGRAPH, section):
            hashes = [md5(p) for p in re.findall(fp.PHRASE, paragraph)]
            h = md5("".join(hashes))
            s_own += h
            s_out += f";{h[:16]}+{len(paragraph)}" + "".join("." + x[:8] for x in hashes)
        own += md5(s_own)
        out += f"/{md5(s_own)[:16]}{s_out}"
    return hashlib.sha256(own.encode()).hexdigest() + out


def likeness(a, b):
    if a[:64] == b[:64]:
        return 1.0
    x, y = (set(re.findall(r"\.([0-9a-f]{8})", f)) for f in (a, b))
    return 2.0 * len(x & y) / (len(x) + len(y) + 2)


def brute_force(rows):
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    after = {d: docs[(k + 1) % len(docs)][2] for k, d in enumerate(docs)}
    out = []
    for i, t in rows:
        t = t or ""
        n = len(t) // 4
        following = after[i is not None, i or 0, t]
        edited = t[:len(t) - n] + following[:n]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), tree(t), tree(edited),
                    round(likeness(tree(t), tree(edited)), 9), round(likeness(tree(t), tree(following)), 9)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                    round(r.near_next, 9)) for r in df.collect()), key=str)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "1 as id", "2 as h1", "3 as has_id", "4 as copies", "'x' as fingerprint")
    assert result(fp.compare_edits(docs)) == brute_force([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert fp.compare_edits(no_docs).collect() == []
    alone = spark.createDataFrame([(3, "one, two. three")], "doc_id long, text string")
    assert result(fp.compare_edits(alone)) == brute_force([(3, "one, two. three")])


def test_texts_without_ids_in_any_partitioning(spark):
    rows = [(k // 3, f"text {k % 7}.\n\n\nmore {k}") for k in range(40)] + [(-5, "first"), (-5, "first")]
    want = brute_force(rows)
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert result(fp.compare_edits(docs)) == want
    # several texts without doc_id are in the order of their hashes: each has a next, and all are written
    bare = spark.createDataFrame([(None, f"text {k % 4}") for k in range(9)], "doc_id long, text string")
    assert fp.compare_edits(bare).count() == 9


def test_order_survives_partition_bounds(spark):
    keys = spark.range(500).selectExpr("true as has_id", "id * 7 as id", "1L as h1", "2L as h2", "id as n_chars")
    before = {r.id: (r.prev_id, r.prev_chars) for r in fp.keys_before(keys).collect()}
    assert before == {7 * k: (7 * ((k - 1) % 500), (k - 1) % 500) for k in range(500)}


def test_equal_texts_and_edits(spark):
    a = "Intro one.\nIntro two.\n\nBody first line, long.\nBody second line.\n\nEnd."
    b = a.replace("second", "other")
    moved = "\n\n".join(reversed(a.split("\n\n")))
    rows = spark.createDataFrame([(a, a), (a, b), (a, ""), ("", a), (a, moved), ("", "")], "a string, b string").select(
        "b", F.struct(fp.fingerprint(F.col("a")).alias("x"), fp.fingerprint(F.col("b")).alias("y")).alias("f")).select(
        "b", "f", fp.differences(F.col("f.x"), F.col("f.y")).alias("d"), fp.likeness(F.col("f.x"), F.col("f.y")).alias("n"))
    same, edit, gone, new, moved_row, empty = rows.collect()
    assert same.f.x == same.f.y and same.d == [] and same.n == 1.0
    assert [b[d.start:d.start + d.chars] for d in edit.d] == ["Body other line.\n"] and 0.5 < edit.n < 1
    assert gone.d == [] and gone.n == 0.0 and new.n == 0.0
    assert "".join(a[d.start:d.start + d.chars] for d in new.d) == a
    assert moved_row.n < 1.0
    assert empty.n == 1.0 and empty.d == []
