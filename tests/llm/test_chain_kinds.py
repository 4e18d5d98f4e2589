"""Names, addresses and births beside the words that they stand beside; recall and precision on held-out lines."""

import time

from eventweave.llm import pii

# None of these lines or names is in the training table.
HELD_OUT = [
    ("My name is [John Smith], born [4 May 1980], living at [12 Oak Street], passport [K12345678]", 4),
    ("Mr [Walter Gray] and Mrs [Ines Ortega] live here", 2),
    ("Name: [Fatima Noor]", 1), ("Dr. [Emil Berg], please come", 1), ("Herr [Jonas Keller] kommt um 8", 1),
    ("she was born on [17 November 1988] in a small town", 1), ("DOB: [11/12/1977]", 1),
    ("date of birth [2003-01-30] as given", 1), ("lives at [88 Forest Avenue] since 2010", 1),
    ("address: [6 Harbour Road], second door", 1), ("resides at [210 Garden Lane]", 1), ("signed [Marta Silva]", 1),
    ("Passport: [X87654321]", 1), ("patient [Lukas Brandt] was seen at 9", 1)]
CLEAN = ["On 4 May 1980 the Oak Street market was full", "In 1999 there were 250 Cars on High Road", "The Name of the Rose",
         "Chapter 12 begins here and Section 4 ends", "He was born in the north and lives by the sea",
         "The doctor met 3 patients and 12 nurses", "Mr and Mrs went home at 8", "Version 2.0 of 3 June is out"]


def spans(text):
    base, added = pii.find([text])
    return [text[a:b] for a, k, b in sorted(base[0] + added[0])]


def test_recall_on_held_out_lines():
    hits = total = 0
    for marked, n in HELD_OUT:
        want = [part.split("]")[0] for part in marked.split("[")[1:]]
        assert len(want) == n
        got = spans(marked.replace("[", "").replace("]", ""))
        hits += sum(w in got for w in want)
        total += n
    assert hits / total >= 0.8, (hits, total)


def test_clean_lines_stay_clean():
    assert sum(bool(spans(line)) for line in CLEAN) <= 1


def test_redaction_is_linear():
    text = "mail a.b@example.org and call +1 415 555 2671 now " * 20_000
    began = time.time()
    out = pii.redact([text])[0]
    assert time.time() - began < 30 and out.count("<email>") == 20_000 and out.count("<phone>") == 20_000
