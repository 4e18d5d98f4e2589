"""Weighted acyclic automata over words: phrases with counts, as arrays.

An automaton is a minimal acyclic transducer. A phrase is a path of arcs from
the start, one per word, and the weight of its last arc is its count (0: not a
phrase of the set, only the start of one). States with equal arcs are one
state, which is decided by a register of states while the sorted phrases are
read from their ends to their starts.

Words are byte strings; arcs name them by their place in the automaton's own
sorted word list. Phrases have 1 to 4 words.
"""

from __future__ import annotations

import struct
from bisect import bisect_left

import numpy as np

LONGEST = 4


def pack_keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sortable 64-bit keys of the phrases ``rows`` (word ids, -1 behind the last word)."""
    r = (rows + 1).astype(np.uint64)
    return (r[:, 0] << np.uint64(32)) | r[:, 1], (r[:, 2] << np.uint64(32)) | r[:, 3]


def unpack_keys(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    mask = np.uint64(0xFFFFFFFF)
    out = np.empty((len(high), LONGEST), dtype=np.int64)
    for k, part in enumerate((high >> np.uint64(32), high & mask, low >> np.uint64(32), low & mask)):
        out[:, k] = part.astype(np.int64) - 1
    return out


def sum_equal(high: np.ndarray, low: np.ndarray, counts: np.ndarray):
    """The distinct keys in order, and the sums of their counts."""
    order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    new = np.ones(len(high), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    return high[at], low[at], np.add.reduceat(counts, at) if len(at) else counts


class _Register:
    """The states so far, each known by its arcs; state 0, the end, has none."""

    def __init__(self):
        none = np.zeros(0, dtype=np.int64)
        self.degrees, self.arcs = [np.zeros(1, dtype=np.int64)], [(none, none, none)]
        self.size = 1
        self.known: dict[bytes, int] = {}                   # states of several arcs
        self.single = (none, none, none, none)              # (label, weight, target, state) of those of one

    def _append(self, degrees, *arcs) -> None:
        self.degrees.append(np.asarray(degrees, dtype=np.int64))
        self.arcs.append(arcs)
        self.size += len(degrees)

    def add(self, cuts, label, weight, target, last: bool = False) -> np.ndarray:
        """The states whose arcs lie between the ``cuts``; ``last``: the start, always a state of its own."""
        degree = np.diff(cuts)
        out = np.zeros(len(degree), dtype=np.int64)
        if last:
            out[:] = self.size
            self._append(degree, label, weight, target)
            return out
        one = np.flatnonzero(degree == 1)
        if len(one):
            out[one] = self._one_arc(label[cuts[one]], weight[cuts[one]], target[cuts[one]])
        raw, width = np.column_stack([label, weight, target]).tobytes(), 24
        new, many, size = [], np.flatnonzero(degree > 1), self.size
        for k, a, b in zip(many.tolist(), cuts[many].tolist(), cuts[many + 1].tolist()):
            key = raw[a * width:b * width]
            state = self.known.get(key)
            if state is None:
                state = self.known[key] = size + len(new)
                new.append(k)
            out[k] = state
        if new:
            keep = np.zeros(len(degree), dtype=bool)
            keep[new] = True
            arcs = np.repeat(keep, degree)
            self._append(degree[new], label[arcs], weight[arcs], target[arcs])
        return out

    def _one_arc(self, *arc) -> np.ndarray:
        """The states of one arc each: sorted together with those known, equal ones side by side."""
        known = len(self.single[3])
        label, weight, target = (np.concatenate(x) for x in zip(self.single[:3], arc))
        order = np.lexsort((weight, target, label))
        l, w, t = label[order], weight[order], target[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (l[1:] != l[:-1]) | (w[1:] != w[:-1]) | (t[1:] != t[:-1])
        example = np.minimum.reduceat(order, np.flatnonzero(new))       # the first of each kind
        kind = np.empty(len(order), dtype=np.int64)
        kind[order] = np.cumsum(new) - 1
        fresh = np.flatnonzero(example >= known)
        state = np.empty(len(example), dtype=np.int64)
        state[example < known] = self.single[3][example[example < known]]
        state[fresh] = self.size + np.arange(len(fresh))
        at = example[fresh]
        self.single = tuple(np.concatenate([x, y]) for x, y in zip(
            self.single, (label[at], weight[at], target[at], state[fresh])))
        self._append(np.ones(len(fresh), dtype=np.int64), label[at], weight[at], target[at])
        return state[kind[known:]]

    def arrays(self):
        """(first arc of each state and the end of the last one's, label, weight, target)."""
        return (np.concatenate([[0], np.cumsum(np.concatenate(self.degrees))]),
                *(np.concatenate(x) for x in zip(*self.arcs)))


class Automaton:
    """Words, and of each state its arcs ``first[s]:first[s + 1]`` (label, weight, target), by label; state 0 is the
    end and the last state the start."""

    def __init__(self, words: list[bytes], first, label, weight, target):
        self.words, self.first, self.label, self.weight, self.target = words, first, label, weight, target

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> Automaton:
        """From sorted distinct phrases (ids of ``words``, which are sorted, -1 behind the last) and their counts."""
        m = len(rows)
        length = (rows >= 0).sum(axis=1)
        differs = np.ones(m, dtype=bool)        # the prefix of d words differs from the row before
        levels = []
        changed = np.zeros(m, dtype=bool)
        changed[:1] = True
        for d in range(LONGEST):
            differs = changed.copy()
            differs[1:] |= rows[1:, d] != rows[:-1, d]
            changed = differs
            at = np.flatnonzero(differs & (rows[:, d] >= 0))     # first row of each prefix of d + 1 words
            levels.append((at, rows[at, d], np.where(length[at] == d + 1, counts[at], 0)))
        states = _Register()
        below = np.zeros(len(levels[-1][0]), dtype=np.int64)     # state behind each prefix of the level
        for d in range(LONGEST - 1, -1, -1):
            at, label, weight = levels[d]
            # the prefixes one word shorter, and which arcs leave each
            parents = levels[d - 1][0] if d else np.zeros(1, dtype=np.int64)
            cuts = np.append(np.searchsorted(at, parents), len(at))
            below = states.add(cuts, label, weight, below, last=not d)
        return cls(words, *states.arrays())

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases (word ids, -1 behind the last) and their counts, shorter ones first."""
        states = np.array([len(self.first) - 2], dtype=np.int64)
        rows = np.full((1, LONGEST), -1, dtype=np.int64)
        found_rows, found = [np.zeros((0, LONGEST), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for d in range(LONGEST):
            begin = self.first[states]
            degree = self.first[states + 1] - begin
            if not degree.sum():
                break
            arcs = np.arange(degree.sum()) + np.repeat(begin - (np.cumsum(degree) - degree), degree)
            rows = np.repeat(rows, degree, axis=0)
            rows[:, d] = self.label[arcs]
            is_phrase = self.weight[arcs] > 0
            found_rows.append(rows[is_phrase])
            found.append(self.weight[arcs][is_phrase])
            states = self.target[arcs]
        return np.concatenate(found_rows), np.concatenate(found)

    def count(self, phrase: list[bytes]) -> int:
        """The count of a phrase, 0 if it is none of the set: a walk along its arcs."""
        state, weight = len(self.first) - 2, 0
        for word in phrase:
            at = bisect_left(self.words, word)
            if at == len(self.words) or self.words[at] != word:
                return 0
            a, b = int(self.first[state]), int(self.first[state + 1])
            arc = a + int(np.searchsorted(self.label[a:b], at))
            if arc == b or self.label[arc] != at:
                return 0
            state, weight = int(self.target[arc]), int(self.weight[arc])
        return weight

    def dump(self) -> bytes:
        """Bytes: the words and, in the least widths that hold them, the arrays."""
        out = []
        for values in (np.diff(self.first), self.label, self.weight, self.target):
            top = int(values.max()) if len(values) else 0
            code = next(c for c, limit in (("B", 2**8), ("H", 2**16), ("I", 2**32), ("q", 2**63)) if top < limit)
            out.append(struct.pack("<cI", code.encode(), len(values)) + values.astype("<" + code).tobytes())
        return b"".join(out) + b"\n".join(self.words)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        at, arrays = 0, []
        for _ in range(4):
            code, n = struct.unpack_from("<cI", data, at)
            kind = np.dtype("<" + code.decode())
            arrays.append(np.frombuffer(data, dtype=kind, count=n, offset=at + 5).astype(np.int64))
            at += 5 + n * kind.itemsize
        degree, label, weight, target = arrays
        words = data[at:].split(b"\n") if len(data) > at else []
        return cls(words, np.concatenate([[0], np.cumsum(degree)]), label, weight, target)


def restrict(words: list[bytes], rows: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words that ``rows`` use, and the rows with the ids of those."""
    used = np.unique(rows)
    used = used[used >= 0]
    place = np.full(len(words) + 1, -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    return [words[k] for k in used.tolist()], place[rows]      # -1 looks up the last place, which is -1


class Union:
    """Sums of the weights of automata that come one by one.

    Holds the distinct phrases seen and up to ``HELD`` that are not summed yet.
    """

    HELD = 1 << 21

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.parts: list[tuple] = []
        self.waiting = 0

    def add(self, automaton: Automaton) -> None:
        rows, counts = automaton.phrases()
        ids = self.ids
        place = np.array([ids.setdefault(w, len(ids)) for w in automaton.words] + [-1], dtype=np.int64)
        self.parts.append((*pack_keys(place[rows]), counts))
        self.waiting += len(rows)
        if self.waiting > self.HELD:
            self._sum()

    def _sum(self) -> None:
        if self.parts:
            self.parts = [sum_equal(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.waiting = 0

    def result(self, least: int = 1) -> Automaton:
        """The automaton of all phrases whose counts sum to ``least`` or more."""
        self._sum()
        if not self.parts:
            return Automaton.build([], np.zeros((0, LONGEST), dtype=np.int64), np.zeros(0, dtype=np.int64))
        high, low, counts = self.parts[0]
        enough = counts >= least
        words = list(self.ids)
        used, rows = restrict(words, unpack_keys(high[enough], low[enough]))
        order = sorted(range(len(used)), key=used.__getitem__)
        rank = np.full(len(used) + 1, -1, dtype=np.int64)
        rank[order] = np.arange(len(used))
        high, low, counts = sum_equal(*pack_keys(rank[rows]), counts[enough])
        return Automaton.build([used[k] for k in order], unpack_keys(high, low), counts)
