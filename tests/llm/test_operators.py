"""Each operator against a brute-force version, and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from eventweave.llm import (
    decontaminate, language, ngram_join, packing, page_text, pii, quality, queries, repeats, secret_scan, toxicity)
from eventweave.llm.tables import connected_components

SPACE = r"[^\x20\x09-\x0D]+"


def texts_of(sf, name="documents", key="doc_id", text="text"):
    return duckdb.sql(f"select {key}, {text} from '{sf}/{name}.parquet' order by 1").fetchall()


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# --- quality rules

def base_stats(text):
    words = re.findall(SPACE, text or "")
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k:k + 3])].append(k)
    covered = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_quality_statistics(spark, sf, odd_docs):
    out = quality.assess(spark.read.parquet(f"{sf}/documents.parquet"))
    want = sorted(((i, *base_stats(t)) for i, t in texts_of(sf)), key=str)
    assert rows_of(out, "doc_id", *COLS) == want
    odd = quality.assess(odd_docs)
    assert rows_of(odd, "doc_id", *COLS) == sorted(
        ((r.doc_id, *base_stats(r.text)) for r in odd_docs.collect()), key=str)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_keeps_good_and_drops_bad(spark, sf):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality.assess(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    good = [kept[i][0] for i, q in labels if q == 1 and not kept[i][1]]
    assert sum(good) >= 0.97 * len(good)
    bad = [kept[i][0] for i, q in labels if q == 0]
    assert sum(bad) <= 0.2 * len(bad)


def test_quality_estimation_finds_accuracies():
    import numpy as np
    rng = np.random.default_rng(3)
    truth = np.array([0.95, 0.8, 0.7, 0.9, 0.6])
    y = rng.random(20_000) < 0.7
    votes = np.where(rng.random((20_000, 5)) < truth, np.where(y, 1, -1)[:, None], np.where(y, -1, 1)[:, None])
    votes[rng.random(votes.shape) < 0.2] = 0
    share, rates = quality.estimate(list(Counter(map(tuple, votes.tolist())).items()))
    assert abs(share - 0.7) < 0.03 and abs(rates[0] - truth).max() < 0.05 and abs(rates[1] - 1 + truth).max() < 0.05
    assert quality.estimate([])[0] == 0.5


# --- n-gram join

def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            where[x].add(i)
    pairs = {(min(a, b), max(a, b)) for v in where.values() for a in v for b in v if a != b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i)) for i, s in sets.items()), key=str)


def near_copies():
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 40):
        words = list(base)
        for j in range(k % 9):
            words[(k * 13 + j * 17) % 120] = f"x{k}_{j}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, "shared passage of exactly these ten words for all " + " ".join(f"v{k}_{j}" for j in range(k))) for k in range(12)]
    return rows + [(200, "a b"), (201, "A  B"), (202, "a b c"), (203, None), (204, "")]


@pytest.mark.parametrize("group", [4000, 3])
def test_ngram_join(spark, sf, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rows_of(ngram_join.similar_groups(df), "doc_id", "n_shingles", "component_id")
    assert got == brute_groups(rows)


def test_ngram_join_on_documents_and_odd_rows(spark, sf, odd_docs, no_docs):
    got = rows_of(ngram_join.similar_groups(spark.read.parquet(f"{sf}/documents.parquet")), "doc_id", "n_shingles", "component_id")
    assert got == brute_groups(texts_of(sf))
    odd = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(odd_docs).collect()}
    assert odd[1] == (0, 1) and odd[2] == (0, 2) and odd[3] == (0, 3) and odd[4] == (1, 4)
    assert odd[5][1] == odd[6][1] == 5 and odd[11][1] == 10 and odd[None] == (6, None)
    assert ngram_join.similar_groups(odd_docs).count() == odd_docs.count()
    assert ngram_join.similar_groups(no_docs).count() == 0


def test_ngram_join_keeps_rows_without_doc_id(spark):
    one, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(None, one + " tail"), (None, one), (9, one), (12, one + " tail end"), (None, other), (None, other + " x"), (None, "")]
    got = rows_of(ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")),
                  "doc_id", "n_shingles", "component_id")
    assert got == sorted([(None, 37, 9), (None, 36, 9), (9, 36, 9), (12, 38, 9), (None, 36, None), (None, 37, None),
                          (None, 0, None)], key=str)


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[100] == got[95] == 90


# --- packing

def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def check_pieces(rows, pieces):
    texts = [t or "" for _, t in rows]
    ids = {i: x + [0] for (i, _), x in zip(rows, reference_ids(texts))}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert len(own) == p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[i])
    sizes = []
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes.append(at)
    assert max(sizes) <= 1024 and sum(s < 1024 for s in sizes) <= 1


def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    check_pieces(texts_of(sf), packing.digests(docs).collect())


def test_packing_odd_texts(spark, no_docs):
    odd = ["", None, " ", "  a", "a  b", "a \n b", "\n\n x", "x\n \ny", "a  b  c", "tab\t tab \t", "it's we'll 12ab", "<|endoftext|> x",
           "a <|endoftext|>  b <|endoftext|><|endoftext|>", "x<|endoftext|>y <|endoftext| > <|ENDOFTEXT|>", "<|endoftext|>",
           "漢字 \U0001f600  z", "end ", "é" * 3000, "a" * 5000, "\x1c x \x85 y"]
    rows = list(enumerate(odd))
    check_pieces(rows, packing.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert packing.pack(no_docs).count() == 0


def test_packed_sequences(spark):
    df = spark.createDataFrame([(k, "some words here " * 50) for k in range(30)], "doc_id long, text string").repartition(4)
    out = packing.sequences(packing.pack(df, length=256)).collect()
    assert all(len(r.ids) == 2 * r.n_tokens for r in out)
    assert sum(r.n_tokens < 256 for r in out) <= 1


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="sidebar"><p>Some long sidebar text that is really quite long and has many words in it, more than any paragraph.</p></div>
%s<section class="comments"><article class="comment"><p>I do not agree with this at all, it is long enough to look like text.</p></article></section>
<form><label>Search</label><input></form><footer>&copy; us &middot; all rights</footer></body></html>"""
BODY = """<h1>Title &amp; more</h1><p>First   paragraph<br>with a <b>bold</b> word and enough text to be an article, surely so.</p>
<!-- <p>hidden</p> --><div class="ad">Buy now</div><p>Short.</p><ul><li>one</li><li>two&nbsp;x</li></ul><p>Last paragraph, again with
enough text to be seen as the main part of this page.</p>"""
TEXT = ("Title & more First paragraph with a bold word and enough text to be an article, surely so. Short. one two x "
        "Last paragraph, again with enough text to be seen as the main part of this page.")


def test_pages_by_hand():
    assert page_text.main_text(PAGE % f"<article>{BODY}</article>") == TEXT
    assert page_text.main_text(PAGE % f"<main>{BODY}</main>") == TEXT
    assert page_text.main_text(PAGE % f"<div>{BODY}</div>") == TEXT
    assert page_text.main_text(None) == page_text.main_text("") == page_text.main_text("<p></p>") == ""
    assert page_text.main_text("<article><p>Tiny.</p></article>") == "Tiny."
    assert page_text.main_text("<article><p>unclosed <b>text") == "unclosed text"


def test_pages(spark, sf, odd_docs, no_docs):
    import html
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for i, page in texts_of(sf, "pages", "page_id", "html"):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)\b[^>]*>", "\n", re.sub(r"</?b>", "", inner))).split())
        assert got[i] == (want, len(want))
    assert page_text.extract(odd_docs, "doc_id", "url", "text").count() == odd_docs.count()
    assert page_text.extract(no_docs, "doc_id", "url", "text").count() == 0


# --- repeats

def brute_repeats(rows):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[k:k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for (i, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if count[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2000, 0])
def test_repeats(spark, sf, monkeypatch, hot):
    import random
    rng = random.Random(5)
    monkeypatch.setattr(repeats, "HOT", hot)
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = texts_of(sf)[:60]
    rows += [(1000 + k, base[:300 + 10 * k] + str(k) + base[300 + 10 * k:]) for k in range(20)]
    rows += [(2000, "a" * 1000), (2001, "a" * 199), (2002, "ab" * 300), (2003, None), (2004, ""), (2005, base[100:299]),
             (2006, base[100:300]), (2007, "é" * 150), (None, "x y" * 100), (rows[0][0], rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(repeats.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows)


def test_repeats_in_segments(monkeypatch, spark):
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    raw = [bytes((k * k * 31 + k * 7) % 251 for k in range(5000)), b"ab" * 1500]
    whole = {(d, s) for d, _, a, b, *_ in zip(*repeats.find_triggers(raw)) for s in range(a, b + 1)}
    assert whole == {(0, s) for s in range(4801)} | {(1, s) for s in range(2801)}


def test_repeats_odd_rows(odd_docs, no_docs):
    out = repeats.remove_repeats(odd_docs)
    got = Counter((r.doc_id, r.n_removed) for r in out.collect())
    longest = len(odd_docs.where("doc_id = 5").first().text)
    assert got[(5, longest)] == 1 and got[(6, longest)] == 2 and got[(8, 300_000)] == 1 and got[(1, 0)] == 1
    assert repeats.remove_repeats(no_docs).count() == 0


# --- decontamination

ITEM = ("A train travels from Paris at 80 km per hour while another train leaves Lyon at 95 km per hour; "
        "how many hours until they meet if Anna waits 3 hours before the second departs?")


def test_templates(spark, no_docs):
    filler = " ".join(f"filler{k}" for k in range(30))
    changed = ITEM.replace("80", "120").replace("95", "75").replace("Paris", "Rome").replace("Anna", "Bob").replace("km", "mi")
    clash = ITEM.replace("Anna waits 3", "Anna waits 80")
    rows = [(1, f"{filler} {ITEM} {filler}"), (2, f"{filler}. {changed}"), (3, filler), (4, None), (5, ""),
            (6, ITEM.upper()[:40]), (7, f"{ITEM} {filler} {ITEM}"), (None, ITEM), (7, f"{ITEM} {filler} {ITEM}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as at")
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "the of"), (5, "short item of six words only"),
                                   (1, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 1), (2, 1), (7, 1)}
    kept = [r.doc_id for r in decontaminate.clean(docs.select("doc_id", "text"), bench).collect()]
    assert sorted(k for k in kept if k is not None) == [3, 4, 5, 6]
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    two = spark.createDataFrame([(1, clash)], "item_id long, text string")
    # 3 and 80 can't both stand where the item has 80 twice
    lines = decontaminate.contaminated(spark.createDataFrame([(9, ITEM)], "doc_id long, text string"), two)
    assert lines.count() == 0


def test_a_clash_takes_nothing_from_a_verbatim_run(spark):
    clash = ITEM.replace("Anna waits 3", "Anna waits 80")
    other = ITEM.replace("at 80", "at 60").replace("at 95", "at 60")        # two values of the item, one of the text
    bench = spark.createDataFrame([(1, clash)], "item_id long, text string")
    docs = spark.createDataFrame([(9, ITEM), (8, other), (7, "nothing of it")], "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(docs, bench).collect()} == {8, 9}
    assert [r.doc_id for r in decontaminate.clean(docs, bench).collect()] == [7]


def test_windows_of_few_literals(spark):
    items = ["Tom has 3 apples in a bag and", "Der Hund und die Katze der Nachbarin Erika Schmidt jagen Tom durch Wald und Feld bis Sonntag",
             "Add 3 and 4 and 5 6 7 8 9 10 11 to 12 13 14 15 16 17 then halve 18 19 20 21 and square", "the of", ITEM]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    numbers = " ".join(str(int(w) + 100) if w.isdigit() else w for w in items[2].split())
    rows = [(0, "We saw: " + items[0]), (1, items[1]), (2, numbers), (3, "the of the of"), (4, ITEM.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(0, 0), (1, 1), (2, 2), (4, 4)}
    tok = decontaminate.Tokens(["take 5 a in", "a man in 7 s"])
    assert tok.slot.tolist() == [False, True, True, False, False, False, False, True, True]


def test_leaks_in_documents(spark, sf):
    items = texts_of(sf, "benchmark", "item_id")
    grams = defaultdict(set)
    for i, t in items:
        w = re.findall(r"\w+", t.lower())
        for k in range(len(w) - 12):
            grams[tuple(w[k:k + 13])].add(i)
    want = set()
    for d, t in texts_of(sf):
        w = re.findall(r"\w+", (t or "").lower())
        want |= {(d, i) for k in range(len(w) - 12) for i in grams.get(tuple(w[k:k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, sf).collect()}
    assert want and got >= want and len(got - want) <= 2


# --- secrets and personal data

def plain_matches(pattern, text, keep, flags=0):
    return [m.span() for m in re.finditer(pattern, text, flags) if keep(m)]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()]
    return 12 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d))) % 10 == 0


SECRETS = [
    (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12, re.A | re.I),
    (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18, 0), (r"[0-9a-f]+", lambda m: len(m[0]) >= 16, 0)]
PERSONAL = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True, 0),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split(".")), 0),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(m[0]), 0),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15, 0)]


def base_text(text, kinds, names):
    found = [(a, k, b) for k, (p, keep, flags) in enumerate(kinds) for a, b in plain_matches(p, text or "", keep, flags)]
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))


TRICKY = ["a@b.c@d.e", "@b.c@d.e x@y", "x.y@a-b.co..uk", "é1.2.3.4.5.6.7.8 999.1.1.1 1.1.1.256", "4111 1111-1111 1111 1", "4111111111111111",
          "+1 (415) 555-2671 +12 +123456789012345678", "token = token = abcdefghijklmnop", 'PassWord" : \'abcdefghijkl', "toKen=abcdefghijklmn",
          "AKIAAKIA1234567890 AKIA12", "0123456789abcdefg 0123456789abcde", "api_key=short api-key=abcdefghijklmn", "", None, "a" * 20000 + "@"]


@pytest.mark.parametrize("scan, kinds, names", [
    (secret_scan.scan, SECRETS, secret_scan.KINDS), (pii.scan, PERSONAL, pii.KINDS)])
def test_base_spans(spark, sf, odd_docs, no_docs, scan, kinds, names):
    rows = texts_of(sf) + [(10_000 + k, t) for k, t in enumerate(TRICKY)]
    out = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, t in rows:
        assert out[i].base == base_text(t, kinds, names)
        assert set(filter(None, out[i].base.split(","))) <= set(out[i].spans.split(","))
    assert scan(odd_docs).count() == odd_docs.count()
    assert scan(no_docs).count() == 0


def test_novel_strings():
    marginal = secret_scan._novelty()
    text = 'client_id: "Zk3vQ9xLw2Rt7Ym5Bn8Pc4Hd" and authorization header, password_reset_requested_by_username_default'
    _, added = secret_scan.scan_text(text, marginal)
    assert [text[a:b] for a, _, b in added] == ["Zk3vQ9xLw2Rt7Ym5Bn8Pc4Hd"]
    assert secret_scan.scan_text("auth: your_token_here_0123456789_abcdefghijklmnop", marginal)[1] == []


def test_chain_labels():
    texts = ["phone (212) 555-0199 now", "ssn 123-45-6789 x", "only plain words here, as ever", "It was 1984 and 12 of them came at 10:30", None, ""]
    _, added = pii.find(texts)
    found = [[texts[k][a:b] for a, _, b in s] for k, s in enumerate(added)]
    assert found[0] == ["(212) 555-0199"] and found[1] == ["123-45-6789"] and found[2:] == [[], [], [], []]
    assert pii.redact(["mail a@b.co or +1 212 555 0199 1", None]) == ["mail <email> or <phone>", None]


def test_viterbi_is_exact():
    import numpy as np
    rng = np.random.default_rng(1)
    lens = np.array([5, 4, 4, 1])
    e, t = rng.normal(size=(14, 3)), rng.normal(size=(3, 3))
    got, at = pii.viterbi(e, lens, t), 0
    for n in lens:
        def total(path, at=at):
            return sum(e[at + k, y] for k, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(n)), key=total)
        assert tuple(got[at:at + n]) == best
        at += n


def test_chain_leaves_plain_lines_alone():
    import numpy as np
    number, w, t = pii.model()
    words = ["The", "and", "Le,", "été", "WORD!!", "x|", "a'b", "(so)"]
    rng = np.random.default_rng(2)
    for _ in range(50):
        part = [words[k] for k in rng.integers(0, len(words), 20)]
        s = pii._emissions(part, number, w)
        e = s[:, 1] + np.vstack([np.zeros((1, len(pii.LABELS))), s[:-1, 0]]) + np.vstack([s[1:, 2], np.zeros((1, len(pii.LABELS)))])
        e[0] += w[number["-edge"]]
        e[-1] += w[number["+edge"]]
        assert not pii.viterbi(e, np.array([20]), t).any()


# --- classifiers

def held_out(i, fold, rest):
    return zlib.crc32(str(i).encode()) % fold == rest


def test_language(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op8_language(spark, sf).collect()}
    rows = duckdb.sql(f"select doc_id, text, lang from '{sf}/documents.parquet'").fetchall()
    test = [(out[i].lang_pred, lang) for i, t, lang in rows if held_out(i, 4, 2) and t and lang]
    assert sum(a == b for a, b in test) >= 0.97 * len(test)
    assert all(out[i].held_out == held_out(i, 4, 2) and 0 <= out[i].score <= 1 for i, _, _ in rows)
    model = language.train(odd_docs)
    got = {r.doc_id: r.lang_pred for r in language.identify(odd_docs, model).collect()}
    assert got[1] == got[2] == got[3] == "und" and set(got.values()) <= {"und", "en", "de", "xx"}
    assert language.train(no_docs) is None and language.identify(odd_docs, None).where("lang_pred <> 'und'").count() == 0
    assert language.identify(no_docs, model).count() == 0


def test_toxicity(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op9_toxicity(spark, sf).collect()}
    rows = duckdb.sql(f"select doc_id, text, toxic from '{sf}/documents.parquet' join '{sf}/labels.parquet' using (doc_id)").fetchall()
    test = [(out[i].predicted, y) for i, t, y in rows if held_out(i, 5, 0)]
    assert sum(a == b for a, b in test) >= 0.93 * len(test)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in out.values())
    model = toxicity.fit(["you idiot fool", "nice calm words", "an idiot again", "more calm text here"] * 30, [1, 0, 1, 0] * 30)
    got = {r.doc_id: r.score for r in toxicity.score(odd_docs, model).collect()}
    assert len(got) == 12 and got[1] < 0.5 and got[2] < 0.5
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.train(odd_docs.selectExpr("*", "0 as toxic")) is None
    assert toxicity.score(odd_docs, None).where("score > 0").count() == 0


def test_network_gradients():
    """Backpropagation through time against differences."""
    import numpy as np
    rng = np.random.default_rng(0)
    p = rng.normal(size=(5, 3, 3 * toxicity.HIDDEN)).astype(np.float32)
    u = (rng.normal(size=(toxicity.HIDDEN, 3 * toxicity.HIDDEN)) * 0.5).astype(np.float32)
    keep = np.ones((5, 3, 1), dtype=np.float32)
    keep[3:, 1] = 0
    weight = rng.normal(size=(5, 3, toxicity.HIDDEN)).astype(np.float32)
    for back in (False, True):
        states, saved = toxicity._gru(p, u, keep, back, True)
        gp, gu = toxicity._gru_back(weight, saved, u, keep)
        for k in [(0, 0), (3, 10), (7, 23)]:
            d = np.zeros_like(u)
            d[k] = 1e-2
            up, down = (float((toxicity._gru(p, u + s * d, keep, back, False)[0] * weight).sum()) for s in (1, -1))
            assert abs((up - down) / 2e-2 - gu[k]) < 2e-2 * max(1, abs(gu[k]))
