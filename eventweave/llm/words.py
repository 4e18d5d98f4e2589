"""Words, lines and shingles of whole texts as numpy arrays.

A word is a run of bytes other than space and the controls 9 to 13; in UTF-8
that is the same as the run of such characters. All functions take a list of
``bytes`` (UTF-8 texts) and work on one concatenated buffer, so their cost is
a few passes over the bytes and their memory a multiple of the batch.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE_KEYS = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LANES = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)

STRETCH = 1 << 18       # bytes of words hashed at a time


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 1024), _STEP, dtype=np.uint64)
        table[0] = 1
        _powers = np.cumprod(table)
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Separators where only runs of ASCII letters, digits and bytes from 128 on count as words.
PUNCTUATION = np.array([not (c >= 128 or chr(c).isalnum()) for c in range(256)])


def word_spans(texts: list[bytes], space: np.ndarray = _SPACE):
    """(buffer, word starts, word ends, first word of each text; one more entry closes the last)."""
    lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = space[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    begins = np.concatenate([[0], np.cumsum(lens + 1)])
    return buf, starts, ends, np.searchsorted(starts, begins)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, space: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash for each word of ``word_spans``.

    Words are taken in stretches of about ``STRETCH`` bytes, since each byte stands for some 40 in between.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lens = ends - starts
    power = _power_table(int(lens.max()))
    upto = np.cumsum(lens)
    out = np.empty(len(lens), dtype=np.uint64)
    cuts = [0, *np.searchsorted(upto, np.arange(STRETCH, int(upto[-1]), STRETCH)).tolist(), len(lens)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            part, n = buf[starts[a]:ends[b - 1]], lens[a:b]
            at = np.cumsum(n) - n
            inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(at, n)
            out[a:b] = np.add.reduceat(_BYTE_KEYS[part[~space[part]]] * power[inside], at)
    return mix64(out)


def word_hashes(texts: list[bytes], space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of all texts, and the first word of each text."""
    buf, starts, ends, first = word_spans(texts, space)
    return span_hashes(buf, starts, ends, space), first


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of the ``width``-word shingles of each text.

    A text of fewer words has its whole sequence as one shingle, one without
    words none.
    """
    words, first = word_hashes(texts)
    n = len(words)
    full = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        full += words[k:k + len(full)] * _LANES[k]
    full = mix64(full + np.uint64(width))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(full[a:b - width + 1]))
        elif b > a:
            short = (words[a:b] * _LANES[:b - a]).sum(dtype=np.uint64)
            out.append(mix64(np.array([short + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
