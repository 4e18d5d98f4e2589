"""Personal data: fixed patterns, and a linear-chain CRF over word shapes.

The patterns give the base spans. The chain labels every word of a text as
nothing or as part of a mail address, a number that identifies someone
(phone, card, account, passport, national id), an address on the network, a
person's name, a street address or a date of birth. It is trained by gradient
ascent on the exact log-likelihood (forward and backward sums) over the small
labelled table below, and decoded by
Viterbi for whole batches of texts at once in numpy: texts are cut at line
ends into sequences, and all sequences step together. A longer line is decoded
in sequences that overlap by ``OVERLAP`` words on each side and give the labels
of their inner words; the words' scores are those of the whole line.

Features of a word: its shape (runs of upper, lower, digit and each other
sign, with run lengths to four), its class of length, how many digits it has,
whether it is a word that such data stand beside (of identifiers, titles,
births, homes, streets, months), and the same of both neighbours; of the word
two before, whether it is such a word. Features are computed once for each
distinct word of a batch. Names, streets and births are found beside such words
only; a name in running prose is not.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.spans import joined, runs
from eventweave.llm.tables import map_texts

KINDS = ["email", "ip", "card", "phone", "crf_mail", "crf_number", "crf_net", "crf_name", "crf_place", "crf_birth"]

# The base patterns. The local part of a mail address is the run before its sign.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


def _emails(text: str) -> list[tuple[int, int]]:
    out, after = [], 0
    if "@" in text:
        for m in _HOST.finditer(text):
            a = m.start()
            while a > after and text[a - 1] in _LOCAL:
                a -= 1
            if a < m.start():
                out.append((a, m.end()))
                after = m.end()
    return out


def _luhn(m: re.Match) -> bool:
    digits = [int(c) for c in m[0] if c not in " -"]
    if not 12 <= len(digits) <= 19:
        return False
    double = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(double)) % 10 == 0


BASE = [
    _emails,
    runs(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", keep=lambda m: all(len(p.lstrip("0")) <= 3 and int(p) <= 255
                                                                 for p in m[0].split("."))),
    runs(r"[0-9](?:[\x20-]?[0-9]){11,}", keep=_luhn),
    runs(r"\+[0-9][\x20().0-9-]+[0-9]", keep=lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15),
]

LABELS = ["O", "mail", "number", "net", "name", "place", "birth"]
_TAGS = {"_m": 1, "_n": 2, "_i": 3, "_p": 4, "_a": 5, "_b": 6}
# The labelled table: words, with _m, _n, _i, _p, _a or _b on those that are mail, number, net, name, place or birth.
TRAINING = """
my name is John_p Miller_p and this is all
hello my name is Sofia_p I work here
my name is Jane_p Cooper,_p born 8_b July_b 1972,_b living at 44_a Pine_a Street,_a call me
My name is Adam_p Stone._p
Mrs Helen_p Park,_p said so
I am Dr. Ivan_p Horvat,_p hello
lives at 16_a Church_a Road._a
born 30_b October_b 2001._b
address: 5_a King_a Square,_a third floor
the meeting , on 8 July 1972, was in the Main Street, at 9
born in Rome, Italy, and living in Paris.
Name: Sarah_p Jennings_p
name : Omar_p Haddad_p
Mr Thomas_p Baker_p called twice
Mr. Henry_p Ford_p will come
Mrs Anna_p Kowalska_p signed it
Mrs. Eva_p Lind_p said no
Dr. Peter_p Novak_p will see you at 10
Ms Laura_p Rossi_p , thanks
Herr Klaus_p Meier_p und Frau Ute_p Vogel_p
signed Paul_p Weber_p
signed: Nina_p Petrova_p
patient Carlos_p Diaz_p arrived
born 4_b May_b 1980_b in the north
born on 12_b March_b 1975_b , living here
she was born 3_b June_b 1991_b
date of birth 1980-05-04_b given
date of birth: 23/11/1969_b
DOB 04/05/1980_b checked
DOB: 1-2-1990_b
geboren am 7._b April_b 1964_b
living at 12_a Oak_a Street_a , near the park
lives at 7_a High_a Road_a now
address: 221_a Baker_a Street_a
address 9_a Elm_a Avenue_a please
resides at 1450_a Lincoln_a Drive_a
he lives at 3_a Mill_a Lane_a
passport K23456789_n was lost
Passport: C01X00T47_n
passport no 533401987_n
on 4 May 1980 it rained all day
the meeting of 12 March 2020 was long
in June 1991 they moved
2021-05-06 was a Thursday
from 1 January to 31 December
The name of the book is The Long Road
a name is a word and his name is known
Mr and Mrs went home
the doctor said so , Mr speaker
The Street was empty and 12 Cars stood there
They walked down High Street and Oak Avenue
the address is in the book
born in the north , she lives at home
living at the sea , 12 miles out
Paris and London and Rome , 3 Cities
Signed copies sell well
This is It . Then 5 Men Came Home
The Council of State met 4 times In Geneva
Ende 250 Und Der Hund Von Der Frau ist da
version 2 of the New Open Source License as printed
under Common Public Terms and the Great Seal Act of 1933
It was. Then it rained. Nothing else 4
rain fell there. Another day came. More of it
so it ended well. Later on. Evening fell , 7 of us left
una casa roja. Otro dia vino. Nada , 2 veces
der Hund bellt. Ende gut und. Alles Gut
write to anna.kowal@mail.example.org_m for details .
mail : j_smith99@post.example.com_m or call +1_n 212_n 555-0143_n today
Contact support at help-desk@example.net_m .
Her address is maria.lopez@correo.example.es_m , she said .
call me at +44_n 20_n 7946_n 0958_n after six
phone : +1_n (415)_n 555-2671_n
phone : (415)_n 555-2671_n
phone 555-867-5309_n or fax
tel 030_n 1234_n 5678_n ask for him
Telephone: 0171-555-1234_n
my number is 212-555-0188_n thanks
call 1-800-555-0199_n now
card 4111_n 1111_n 1111_n 1111_n expires soon
card number 5500-0000-0000-0004_n was used
visa 4012888888881881_n on file
account DE89370400440532013000_n at the bank
IBAN GB29NWBK60161331926819_n please
iban : FR1420041010050500013M02606_n
ssn 078-05-1120_n on the form
SSN: 219-09-9999_n
passport X1234567_n issued
the server 192.168.0.12_i answered
login from 10.0.0.1_i failed
host 2001:db8::ff00:42:8329_i is up
address fe80::1ff:fe23:4567:890a_i seen
ip : 203.0.113.77_i blocked
MAC 00:1B:44:11:3A:B7_i of the card
it is the of and that this with from
in 1999 there were 250 of them .
The year 2024 was good , about 15 percent more
chapter 12 section 3.4 page 118
price 1,250.00 or 19.99 each
version 1.2.3 of the tool
10 apples and 20 pears cost 3 dollars
at 10:30 we met , until 12:45
on 2021-05-06 it rained
between 1914-1918 the war
score 3-2 after 90 minutes
Room 101 is next to room 102
see http://example.com/a/b for more
item #4521 and order 778812
build 20240115 passed 1500 tests
a and-or b , e.g. this i.e. that
THE END OF THE STORY!! AGAIN!! AND!! AGAIN!!
one### two&&& three%%% four$$$ five***
alpha | beta | gamma | delta
Ende gut , alles gut . Der Hund und die Katze
le chat et la souris sont ici , dans le jardin
el perro y la casa , que no es de la calle
Licensed under the Apache License , Version 2.0 .
Copyright 2019 by the authors . All rights reserved .
token = "0c5d9e1fa7b34826" here
commit 7f3a9c02e4 fixed it
99 bottles!!! of,, it??
sha 9f86d081884c7d659a2feaa0c55ad015 done
the handle @someone said so
3.14159 and 2.71828 are numbers
12345 67890 and 424242 only counts
1 2 3 4 5 6 7 8 9
x = 100 ; y = 200 ; z = 300
"""
_HINT = re.compile(r"^(?:phone|tel|telephone|call|fax|mobile|number|card|visa|account|iban|ssn|passport)[:.]?$", re.I)
# Words beside which names, births and homes stand, by kind.
_BESIDE = {word: kind for kind, words in {
    "who": "name mr mrs ms miss dr prof herr frau senor senora monsieur madame signed patient dear",
    "born": "born dob birth birthday geboren",
    "home": "living lives live address resides residing resident",
    "road": "street road avenue lane drive square boulevard",
    "month": "january february march april may june july august september october november december",
}.items() for word in words.split()}
_SIGNS = "@:./+-()#"


def _shape(word: str) -> list[str]:
    """The features of one word."""
    out, last, run = [], "", 0
    digits = 0
    for c in word:
        if "0" <= c <= "9":
            k = "9"
            digits += 1
        elif c in _SIGNS:
            k = c
        elif c.isalpha():
            k = "A" if c.isupper() else "a"
        else:
            k = "_"
        if k == last:
            run += 1
        else:
            if last:
                out.append(last + str(min(run, 4)))
            last, run = k, 1
    out.append(last + str(min(run, 4)) if last else "")
    core = "".join(out)
    names = [f"s={core}", f"d={min(digits, 16) if digits < 6 else 6 + min(digits, 40) // 4}",
             f"l={min(len(word), 32) // 4}", f"h={bool(_HINT.match(word))}"]
    if (kind := _BESIDE.get(word.rstrip(".:,").lower())) is not None:
        names.append(f"k={kind}")
    names += [f"c={c}" for c in _SIGNS if c in word]
    if not digits and "@" not in word and ":" not in word:
        names.append("plain")
    return names


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@functools.lru_cache(maxsize=1)
def model():
    """(feature numbers, weights, transitions) fitted on the labelled table."""
    rows = []
    for line in TRAINING.strip().split("\n"):
        words, labels = [], []
        for w in line.split():
            tag = _TAGS.get(w[-2:], 0)
            words.append(w[:-2] if tag else w)
            labels.append(tag)
        rows.append((words, labels))
    number: dict[str, int] = {}
    coded = []
    for words, labels in rows:
        own = [_shape(w) for w in words]
        at = []
        for i in range(len(words)):
            names = [f"0{f}" for f in own[i]]
            names += [f"-{f}" for f in (own[i - 1] if i else ["edge"])]
            names += [f"+{f}" for f in (own[i + 1] if i + 1 < len(words) else ["edge"])]
            names += [f"={f}" for f in (own[i - 2] if i > 1 else []) if f.startswith("k=")]
            at.append([number.setdefault(f, len(number)) for f in names])
        coded.append((at, labels))
    k = len(LABELS)
    w, t = np.zeros((len(number), k)), np.zeros((k, k))
    gw2, gt2 = np.full_like(w, 1e-8), np.full_like(t, 1e-8)
    for _ in range(60):
        gw, gt = -0.02 * w, -0.02 * t
        for at, labels in coded:
            e = np.array([w[f].sum(axis=0) for f in at])
            n = len(at)
            fwd, bwd = np.zeros((n, k)), np.zeros((n, k))
            fwd[0] = e[0]
            for i in range(1, n):
                fwd[i] = e[i] + _log_sum(fwd[i - 1][:, None] + t, 0)
            for i in range(n - 2, -1, -1):
                bwd[i] = _log_sum(t + (e[i + 1] + bwd[i + 1])[None, :], 1)
            z = _log_sum(fwd[-1], 0)
            p = np.exp(fwd + bwd - z)
            for i, f in enumerate(at):
                d = -p[i]
                d[labels[i]] += 1
                np.add.at(gw, f, d)
            for i in range(1, n):
                gt -= np.exp(fwd[i - 1][:, None] + t + (e[i] + bwd[i])[None, :] - z)
                gt[labels[i - 1], labels[i]] += 1
        gw2 += gw ** 2
        gt2 += gt ** 2
        w += 0.5 * gw / np.sqrt(gw2)
        t += 0.5 * gt / np.sqrt(gt2)
    return number, w, t


def viterbi(e: np.ndarray, lens: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best label of each word; sequences lie one after another in ``e``, longest first."""
    k = e.shape[1]
    start = np.cumsum(lens) - lens
    score = e.copy()
    back = np.zeros(e.shape, dtype=np.int8)
    longest = int(lens[0]) if len(lens) else 0
    active = len(lens)
    for i in range(1, longest):
        active = int(np.searchsorted(-lens, -i, side="left"))     # sequences longer than i
        now = start[:active] + i
        step = score[now - 1][:, :, None] + t[None]
        best = step.argmax(axis=1)
        back[now] = best
        score[now] += np.take_along_axis(step, best[:, None, :], axis=1)[:, 0]
    labels = np.zeros(len(e), dtype=np.int8)
    if len(lens):
        last = start + lens - 1
        labels[last] = score[last].argmax(axis=1)
        for i in range(longest - 1, 0, -1):
            active = int(np.searchsorted(-lens, -i, side="left"))
            now = start[:active] + i
            labels[now - 1] = back[now, labels[now]]
    assert k == t.shape[0]
    return labels


_WORD = re.compile(r"[^\x20\x09-\x0D|]+")
_HARD = re.compile(r"[0-9@]")
_TITLE = re.compile(r"\b(?:name|mrs?|ms|miss|dr|prof|herr|frau|senor|senora|monsieur|madame|signed|patient)\b", re.I)
_cache: dict[str, np.ndarray] = {}
CACHE_WORDS = 50_000
SEQUENCE_WORDS = 256
OVERLAP = 64


def _emissions(words: list[str], number: dict, w: np.ndarray) -> np.ndarray:
    """For each word its scores as previous, own, next and second previous word: (words, 4, labels)."""
    out = np.zeros((len(words), 4, w.shape[1]), dtype=np.float32)
    for k, word in enumerate(words):
        if (got := _cache.get(word)) is None:
            got = np.zeros((4, w.shape[1]), dtype=np.float32)
            for f in _shape(word):
                for place, mark in enumerate("-0+="):
                    if (n := number.get(mark + f)) is not None:
                        got[place] += w[n]
            if len(_cache) >= CACHE_WORDS:
                _cache.clear()
            if len(word) <= 64:
                _cache[word] = got
        out[k] = got
    return out


def chain_spans(texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, label, end) of the runs of words that the chain labels, for each text.

    Lines without a digit, an at sign or a title have one outcome: nothing.
    Others are decoded in full, in sequences of ``SEQUENCE_WORDS`` words and
    their overlaps that step together.
    """
    number, w, t = model()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    rows, words = [], []                # lines, and the words of all
    for d, text in enumerate(texts):
        if not text or not (_HARD.search(text) or _TITLE.search(text)):
            continue
        at = 0
        for line in text.split("\n"):
            if _HARD.search(line) or _TITLE.search(line):
                found = list(_WORD.finditer(line))
                if found:
                    rows.append((len(found), d, at, found))
                    words.extend(m[0] for m in found)
            at += len(line) + 1
    if not words:
        return out
    lens = np.array([r[0] for r in rows])
    scores = _emissions(words, number, w)
    e = scores[:, 1].copy()
    first = np.cumsum(lens) - lens
    inner = np.ones(len(words), dtype=bool)
    inner[first] = False
    e[inner] += scores[np.flatnonzero(inner) - 1, 0]
    e[np.flatnonzero(inner) - 1] += scores[inner, 2]
    second = inner.copy()
    second[first[lens > 1] + 1] = False         # the second word of a line has none two before
    e[second] += scores[np.flatnonzero(second) - 2, 3]
    edge = np.zeros(w.shape[1], dtype=np.float32)
    for mark, ends in (("-edge", first), ("+edge", first + lens - 1)):
        if mark in number:
            edge = w[number[mark]].astype(np.float32)
            e[ends] += edge
    # (first word, words, inner words' first and end) of each sequence, longest first
    seqs = []
    for k, n in zip(first.tolist(), lens.tolist()):
        for a in range(0, n, SEQUENCE_WORDS):
            low, high = max(0, a - OVERLAP), min(n, a + SEQUENCE_WORDS + OVERLAP)
            seqs.append((high - low, k + low, k + a, k + min(n, a + SEQUENCE_WORDS)))
    seqs.sort(key=lambda s: -s[0])
    size, low, begin, end = np.array(seqs).T
    turn = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    word = np.repeat(low, size) + turn
    got = viterbi(e[word].astype(np.float64), size, t)
    own = (word >= np.repeat(begin, size)) & (word < np.repeat(end, size))
    labels = np.zeros(len(words), dtype=np.int8)
    labels[word[own]] = got[own]
    k = 0
    for n, d, at, found in rows:
        mine = labels[k:k + n]
        k += n
        for i in np.flatnonzero(mine).tolist():
            a, b, label = at + found[i].start(), at + found[i].end(), int(mine[i])
            if label > 3 and (i + 1 == n or mine[i + 1] != label):
                b -= len(found[i][0]) - len(found[i][0].rstrip(".,;:!?"))       # the sentence's sign, not the name's
            if out[d] and i and mine[i - 1] == label and out[d][-1][1] == label and out[d][-1][2] == at + found[i - 1].end():
                out[d][-1] = (out[d][-1][0], label, b)
            else:
                out[d].append((a, label, b))
    return out


def find(texts: list[str | None]) -> tuple[list, list]:
    """Base spans and added spans, (start, kind number, end), of each text."""
    base = [[(a, k, b) for k, f in enumerate(BASE) for a, b in f(t)] if t else [] for t in texts]
    added = []
    for mine, got in zip(base, chain_spans([t or "" for t in texts])):
        taken = _merge(mine)[::-1]
        ends = [b for _, b, _ in taken]
        added.append([(a, 3 + label, b) for a, label, b in got
                      if (k := bisect_right(ends, a)) == len(taken) or taken[k][0] >= b])
    return base, added


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans): comma-joined kind:start:end.

    ``base`` has the pattern spans, ``spans`` also those of the chain. A null
    or empty text has none. Every row gives a row; repeated rows repeat, other
    columns are not read, an empty table gives an empty result.
    """
    def run(keys, texts):
        base, added = find(texts)
        counts = [[sum(k == n for _, k, _ in b) for b in base] for n in range(4)]
        return [keys, *counts, [joined(b, KINDS) for b in base],
                [joined(b + a, KINDS) for b, a in zip(base, added)]]

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text, run,
                     f"{key} long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def redact(texts: list[str | None]) -> list[str | None]:
    """The texts with every span, base or added, replaced by its kind in angle brackets."""
    out = []
    for text, base, added in zip(texts, *find(texts)):
        if text and (base or added):
            parts, at = [], 0
            for a, b, k in reversed(_merge(base + added)):
                parts += [text[at:a], f"<{KINDS[k].removeprefix('crf_')}>"]
                at = b
            text = "".join([*parts, text[at:]])
        out.append(text)
    return out


def redact_rows(docs: DataFrame) -> DataFrame:
    """The rows of documents(doc_id, text, lang, source, n_chars) with redacted texts.

    ``n_chars`` follows a text that changed; a null text stays null.
    """
    rows = docs.select(F.struct("doc_id", "text", "lang", "source", "n_chars").alias("row"), "text")

    def run(keys, texts):
        new = redact(texts)
        chars = [k["n_chars"] if a == b else len(b) for k, a, b in zip(keys, texts, new)]
        return [[k["doc_id"] for k in keys], new, [k["lang"] for k in keys], [k["source"] for k in keys], chars]

    return map_texts(rows, "row", "text", run, "doc_id long, text string, lang string, source string, n_chars long")


def _merge(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the joined overlapping spans, last first."""
    out: list[list[int]] = []
    for a, k, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, k])
    return [tuple(x) for x in reversed(out)]


def digests(docs: DataFrame) -> DataFrame:
    """The scan with ``base`` as its SHA-256."""
    return scan(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                             F.sha2("base", 256).alias("base_sha256"), "spans")
