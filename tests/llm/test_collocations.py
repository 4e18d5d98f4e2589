"""Automata, and phrases by brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from eventweave.llm import collocations as co
from eventweave.llm.automata import LONGEST, Automaton, Union


def automaton_of(counts: dict[tuple, int]) -> Automaton:
    words = sorted({w for p in counts for w in p})
    place = {w: k for k, w in enumerate(words)}
    rows = sorted((*[place[w] for w in p], *[-1] * (LONGEST - len(p))) for p in counts)
    return Automaton.build(words, np.array(rows, dtype=np.int64).reshape(-1, LONGEST), np.array(
        [counts[tuple(words[k] for k in r if k >= 0)] for r in rows], dtype=np.int64))


def content(a: Automaton) -> dict[tuple, int]:
    rows, counts = a.phrases()
    return {tuple(a.words[k] for k in r if k >= 0): n for r, n in zip(rows.tolist(), counts.tolist())}


def some_phrases(seed: int, n: int) -> dict[tuple, int]:
    pick = random.Random(seed)
    words = [b"a", b"b", b"bc", "é".encode(), b"\x01", b"zz"]
    return {tuple(pick.choice(words) for _ in range(pick.randint(1, 4))): pick.choice([1, 1, 2, 70_000, 1 << 40])
            for _ in range(n)}


@pytest.mark.parametrize("seed,n", [(1, 0), (2, 1), (3, 40), (4, 400)])
def test_automaton_holds_its_phrases(seed, n):
    want = some_phrases(seed, n)
    a = automaton_of(want)
    assert content(a) == want
    again = Automaton.load(a.dump())
    assert content(again) == want and again.dump() == a.dump()
    for p, f in want.items():
        assert again.count(list(p)) == f
    assert again.count([b"nothing"]) == 0 and again.count([]) == 0
    assert all(again.count([*p, b"a"]) == want.get((*p, b"a"), 0) for p in want)


def test_states_with_equal_arcs_are_one():
    # the same 5 continuations behind 50 words: a start, one state behind all the words, the end
    a = automaton_of({(str(i).encode().rjust(2, b"0"), str(j).encode()): 7 for i in range(50) for j in range(5)})
    assert len(a.first) - 1 == 3 and len(a.label) == 50 + 5


def test_union_sums_and_prunes(monkeypatch):
    monkeypatch.setattr(Union, "HELD", 50)          # sums several times on the way
    parts = [some_phrases(s, 60) for s in range(8)]
    union, want = Union(), Counter()
    for p in parts:
        union.add(automaton_of(p))
        want.update(p)
    assert content(union.result()) == dict(want)
    assert content(union.result(3)) == {p: n for p, n in want.items() if n >= 3}


def brute_force(rows, least, top):
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        c = counts.setdefault("und" if lang is None else lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            c.update(tuple(w[i:i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
    out = []
    for lang, c in counts.items():
        n = sum(f for p, f in c.items() if len(p) == 1)
        candidates = [p for p, f in c.items() if len(p) > 1 and f >= least]
        found = []
        for p in candidates:
            if any(100 * c[q] >= 80 * c[p] for q in candidates if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((2000000 * c[p] // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def result(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.select(COLS).collect())


def test_collocations_equal_brute_force(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert result(co.collocations(docs, least=12, top=25, parts=3)) == brute_force(rows, 12, 25)


def test_collocations_odd_rows(spark, odd_docs, no_docs):
    hot = spark.sql("select id as doc_id, 'New York, new york city hall. the end\\u000bof It' as text, if(id < 40, null, 'en') as lang, "
                    "1 as n_chars, 's' as source from range(90)")
    docs = hot.unionByName(odd_docs.select("doc_id", "text", "lang", "n_chars", "source"), allowMissingColumns=True)
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = brute_force(rows, 30, 40)
    assert any(r[2] == "new york" for r in want) and any(r[0] == "und" for r in want)
    assert result(co.collocations(docs.withColumn("part", docs.doc_id).withColumn("phrase", docs.text), top=40)) == want
    assert co.collocations(no_docs).collect() == []
