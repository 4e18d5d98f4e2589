"""Quality rules under weak supervision.

Rules look at a text's statistics and vote good, bad or abstain. No rule
decides alone: expectation-maximisation over the counts of all vote patterns
of the corpus estimates the share of good texts and, for each rule, how often
it is right on good and on bad texts when it votes, and a text is kept when the posterior probability that
it is good reaches one half and it passes the fixed base checks.

The statistics take one pass over the texts and are landed as a narrow table.
Vote patterns are counted by Spark; there are at most 3 to the number of rules
of them, whatever the size of the corpus, and only those counts reach the
driver for the estimation.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import land, map_texts
from eventweave.llm.words import _SPACE, mix64, word_hashes, _LANES

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True    # fixed values
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_LETTER = np.array([chr(c).isalpha() and c < 128 or c >= 192 for c in range(256)])
_HEAD = np.array([c & 0xC0 != 0x80 for c in range(256)])    # bytes that begin a code point

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "n_lines long, n_upper long, n_letters long, n_ended long")


def _per_text(flags: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[begins[1:]] - total[begins[:-1]]


def _lines(text: str) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, those that end like a sentence."""
    seen, n, dup, ended = set(), 0, 0, 0
    for line in text.split("\n"):
        bare = line.strip(" \t\n\r\x0b\x0c")
        if bare:
            n += 1
            ended += bare[-1] in ".!?:;\"'”»)"
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return n, dup, ended


def text_stats(texts: list[str | None]) -> list:
    """One array for each of ``STATS``; a null text counts as empty."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words, first = word_hashes(raw)
    n_words = np.diff(first)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
    inside = ~_SPACE[buf]
    # words in three-word windows that occur twice in their text
    owner = np.repeat(np.arange(len(raw), dtype=np.uint64), n_words)
    covered = np.zeros(len(words) + 2, dtype=bool)
    if len(words) > 2:
        window = mix64(words[:-2] * _LANES[0] + words[1:-1] * _LANES[1] + words[2:] * _LANES[2] + owner[:-2] * _LANES[3])
        whole = np.flatnonzero(owner[:-2] == owner[2:])
        order = whole[np.argsort(window[whole], kind="stable")]
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = order[twice]
        for k in range(3):
            covered[at + k] = True
    lines = np.array([_lines(t or "") for t in texts], dtype=np.int64).reshape(-1, 3)
    return [n_words, _per_text(inside & _HEAD[buf], begins), _per_text(_SYMBOL[buf], begins),
            lines[:, 1], _per_text(covered[:len(words)], first), lines[:, 0],
            _per_text(_UPPER[buf], begins), _per_text(_LETTER[buf], begins), lines[:, 2]]


def _rule(good, bad):
    return F.when(good, 1).when(bad, -1).otherwise(0)


def votes() -> dict:
    """The rules, as vote columns over the statistics: 1 good, -1 bad, 0 abstains."""
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    letters, some = F.col("n_letters"), F.col("n_words") >= 30
    return {
        "symbols": _rule((F.col("n_symbols") * 100 <= words) & some, F.col("n_symbols") * 10 >= words),
        "line_copies": _rule((F.col("n_dup_lines") == 0) & (lines >= 5), F.col("n_dup_lines") * 3 > lines),
        "repeats": _rule((F.col("n_repeat_words") * 20 <= words) & some, F.col("n_repeat_words") * 4 > words),
        "capitals": _rule((F.col("n_upper") * 10 <= letters) & some, F.col("n_upper") * 4 > letters),
        "letters": _rule(letters * 100 >= chars * 92, letters * 100 < chars * 86),
        "sentences": _rule((F.col("n_ended") * 10 >= lines * 9) & (lines >= 3), F.col("n_ended") * 2 < lines),
        "word_size": _rule((chars * 2 >= words * 7) & (chars * 2 <= words * 13), (chars < words * 2) | (chars > words * 12)),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 300) -> tuple[float, np.ndarray]:
    """(share of good texts, how often each rule that votes votes good: on good texts, on bad ones).

    ``patterns`` has vote patterns with their counts. Texts without a bad vote
    begin as likely good, others as likely bad; each round counts the votes
    anew under the posterior of every pattern and takes the posterior of the
    counts. Abstentions say nothing. One vote of each kind is added to every
    count, so that no rate reaches 0 or 1.
    """
    if not patterns:
        return 0.5, np.full((2, 0), 0.5)
    v = np.array([p for p, _ in patterns], dtype=np.int8)
    n = np.array([c for _, c in patterns], dtype=np.float64)
    p = np.where((v == -1).any(axis=1), 0.2, 0.9)
    for _ in range(rounds):
        share = float((n @ p + 1) / (n.sum() + 2))
        weights = np.stack([n * p, n * (1 - p)])
        good, bad = weights @ (v == 1), weights @ (v == -1)
        rates = (good + 1) / (good + bad + 2)
        new = posterior(v, share, rates)
        moved = np.abs(new - p).max()
        p = new
        if moved < 1e-9:
            break
    return share, rates


def posterior(v: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """Probability that a text with these votes is good."""
    for_good, for_bad = np.log(rates[0] / rates[1]), np.log((1 - rates[0]) / (1 - rates[1]))
    return 1 / (1 + np.exp(-(np.log(share / (1 - share)) + (v == 1) @ for_good + (v == -1) @ for_bad)))


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, statistics, base_failed, p_good, kept) of every row.

    Null and empty texts have no words and fail the base checks. Repeated
    rows repeat; an empty table gives an empty result; other columns are not
    read.
    """
    stats = land(map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text,
                           lambda keys, texts: [keys, *text_stats(texts)], f"{key} long, {STATS}"), "quality")
    rules = votes()
    voted = stats.select("*", *[v.cast("byte").alias(f"vote_{k}") for k, v in rules.items()])
    names = [f"vote_{k}" for k in rules]
    counted = voted.groupBy(*names).count().collect()     # at most 3 ** len(rules) rows
    share, rates = estimate([(tuple(r[:-1]), r[-1]) for r in counted])
    odds = F.lit(float(np.log(share / (1 - share))))
    for name, on_good, on_bad in zip(names, *rates.tolist()):
        odds = odds + (F.when(F.col(name) == 1, float(np.log(on_good / on_bad)))
                       .when(F.col(name) == -1, float(np.log((1 - on_good) / (1 - on_bad)))).otherwise(0.0))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (voted.withColumn("base_failed", failed).withColumn("p_good", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)).drop(*names))
