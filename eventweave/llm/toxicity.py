"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read as overlapping windows of words. A word's input has two parts:
the sum of its character n-grams' vectors, and its own vector, both from
hashed tables. Two gated recurrent units read a window forwards and backwards;
attention weighs their states to one vector and a logistic output scores the
window. A text's score is that of its worst window, so one insult in a long
text counts.

Training has labels of whole texts only. The first number of every vector
starts as the smoothed log-odds of seeing that n-gram or word in toxic texts;
each epoch then takes the highest-scoring window of every toxic text as
positive, the highest-scoring and a random window of every other as negative,
and runs minibatch gradient descent (Adam) through time. It uses at most
``SAMPLE`` labelled texts, those with the least hash of their key, a bound
that does not grow with the corpus. Every text is scored whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import give_back, map_texts, scratch_root
from eventweave.llm.words import PUNCTUATION, mix64, word_spans, _power_table, _BYTE_KEYS

SAMPLE = 3000           # labelled texts for training, whole, of at most SAMPLE_CHARS characters each
CLASS_ROWS = 200        # of each label at least, where there are so many
SAMPLE_CHARS = 20_000
WINDOW, STRIDE = 32, 24
HIDDEN, CHAR_DIM, WORD_DIM = 8, 4, 4
TABLE = 1 << 17         # hashed vectors for n-grams, and as many for words
NGRAMS = (3, 4, 5)
EPOCHS = 3


class Words:
    """The words of a batch, as numbers of its distinct words, and those words' hashed features."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
        buf, starts, ends, self.first = word_spans(raw, PUNCTUATION)
        lens = ends - starts
        n = len(starts)
        if not n:
            self.index = np.zeros(0, dtype=np.int64)
            self.word = np.zeros(0, dtype=np.int64)
            self.gram, self.gram_first = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            return
        power = _power_table(int(lens.max()))
        at = np.cumsum(lens) - lens
        inside = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
        hashes = mix64(np.add.reduceat(_BYTE_KEYS[buf[~PUNCTUATION[buf]]] * power[inside], at))
        distinct, example, self.index = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct >> np.uint64(40)).astype(np.int64) % TABLE
        # characters of the distinct words, each between two marks
        size = lens[example]
        wide = size + 2
        begin = np.cumsum(wide) - wide
        chars = np.zeros(int(wide.sum()), dtype=np.uint32)
        off = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
        chars[np.repeat(begin, size) + 1 + off] = buf[np.repeat(starts[example], size) + off]
        owner = np.repeat(np.arange(len(size)), wide)
        left = np.repeat(begin + wide, wide) - np.arange(len(chars))
        grams, owners = [], []
        h = np.zeros(len(chars), dtype=np.uint32)
        for k in range(max(NGRAMS)):
            h = h[:len(chars) - k] * np.uint32(0x01000193) + chars[k:] + np.uint32(1)
            if k + 1 in NGRAMS:
                whole = left[:len(h)] > k
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                mixed = (mixed ^ (mixed >> np.uint32(13))) + np.uint32(k * 7919)
                grams.append(mixed[whole].astype(np.int64) % TABLE)
                owners.append(owner[:len(h)][whole])
        gram, own = np.concatenate(grams), np.concatenate(owners)
        order = np.argsort(own, kind="stable")
        self.gram = gram[order]
        self.gram_first = np.searchsorted(own[order], np.arange(len(size)))

    def inputs(self, model: dict) -> np.ndarray:
        """(distinct words + 1, inputs); the last row is the padding."""
        out = np.zeros((len(self.word) + 1, CHAR_DIM + WORD_DIM), dtype=np.float32)
        if len(self.word):
            out[:-1, :CHAR_DIM] = np.add.reduceat(model["char"][self.gram], self.gram_first, axis=0)
            out[:-1, CHAR_DIM:] = model["word"][self.word]
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of each window, -1 for padding; the text each belongs to)."""
        n = np.diff(self.first)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        owner = np.repeat(np.arange(len(n)), count)
        turn = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        place = turn[:, None] * STRIDE + np.arange(WINDOW)
        inside = place < n[owner][:, None]
        at = np.where(inside, self.first[:-1][owner][:, None] + place, 0)
        return np.where(inside, self.index[at] if len(self.index) else -1, -1), owner


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(p: np.ndarray, u: np.ndarray, keep: np.ndarray, back: bool, trace: bool):
    """States (time, windows, HIDDEN) for projected inputs p (time, windows, 3 HIDDEN)."""
    steps, n, _ = p.shape
    h = np.zeros((n, HIDDEN), dtype=np.float32)
    states = np.zeros((steps, n, HIDDEN), dtype=np.float32)
    saved = []
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        hu = h @ u[:, :2 * HIDDEN]
        zr = _sigmoid(p[t, :, :2 * HIDDEN] + hu)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(p[t, :, 2 * HIDDEN:] + (r * h) @ u[:, 2 * HIDDEN:])
        new = h + keep[t] * z * (c - h)
        if trace:
            saved.append((t, h, z, r, c))
        h = new
        states[t] = h
    return states, saved


def _gru_back(grad_states: np.ndarray, saved: list, u: np.ndarray, keep: np.ndarray):
    steps, n, _ = grad_states.shape
    gp = np.zeros((steps, n, 3 * HIDDEN), dtype=np.float32)
    gu = np.zeros_like(u)
    gh = np.zeros((n, HIDDEN), dtype=np.float32)
    for t, h, z, r, c in reversed(saved):
        gh = gh + grad_states[t]
        gk = gh * keep[t]
        gc = gk * z * (1 - c * c)
        gz = gk * (c - h) * z * (1 - z)
        grh = gc @ u[:, 2 * HIDDEN:].T
        gr = grh * h * r * (1 - r)
        gp[t] = np.concatenate([gz, gr, gc], axis=1)
        gu[:, :2 * HIDDEN] += h.T @ gp[t, :, :2 * HIDDEN]
        gu[:, 2 * HIDDEN:] += (r * h).T @ gc
        gh = gh - gk * z + grh * r + gp[t, :, :2 * HIDDEN] @ u[:, :2 * HIDDEN].T
    return gp, gu


def _forward(model: dict, inputs: np.ndarray, windows: np.ndarray, trace: bool = False):
    """Logits of windows, given distinct words' inputs."""
    w = windows.T                                          # time first
    keep = (w >= 0)[:, :, None].astype(np.float32)
    states, saves = [], []
    for side in ("f", "b"):
        p = (inputs @ model["w" + side] + model["b" + side])[w]
        s, saved = _gru(p, model["u" + side], keep, side == "b", trace)
        states.append(s)
        saves.append(saved)
    h = np.concatenate(states, axis=2)
    a = h @ model["attend"] - 1e9 * (1 - keep[:, :, 0])
    a = np.exp(a - a.max(axis=0))
    a /= a.sum(axis=0)
    pooled = (a[:, :, None] * h).sum(axis=0)
    logit = pooled @ model["out"] + model["bias"]
    return (logit, (w, keep, h, a, pooled, saves)) if trace else logit


def logits(model: dict, texts: list[str | None]) -> np.ndarray:
    """The logit of each text's worst window; without words, that of an empty window."""
    words = Words(texts)
    windows, owner = words.windows()
    out = np.full(len(texts), np.float32(model["empty"]), dtype=np.float32)
    if len(windows):
        inputs = words.inputs(model)
        value = np.concatenate([_forward(model, inputs, windows[a:a + 1024]) for a in range(0, len(windows), 1024)])
        at = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[at]] = np.maximum.reduceat(value, at)
    return out


def _odds(seen: np.ndarray, share: float, prior: float = 10.0) -> np.ndarray:
    """Smoothed log-odds of each hashed id from ``seen`` (label, id): the share of its texts that are toxic, over
    the mean share."""
    share = max(share, 1e-6)
    return np.log((seen[1] + prior * share) / (seen.sum(axis=0) + prior) / share).astype(np.float32)


def fit(texts: list[str], labels: list[int], seed: int = 11) -> dict:
    """Train the network; deterministic for given rows."""
    rng = np.random.Generator(np.random.PCG64(seed))
    y = np.array(labels, dtype=np.int64)
    seen_gram, seen_word, chunks = np.zeros((2, TABLE)), np.zeros((2, TABLE)), []
    for a in range(0, len(texts), 200):
        words = Words(texts[a:a + 200])
        ends = np.append(words.gram_first[1:], len(words.gram)) if len(words.word) else words.gram_first
        sizes = ends - words.gram_first
        for x, z, label in zip(words.first[:-1], words.first[1:], labels[a:a + 200]):
            own = np.unique(words.index[x:z])
            seen_word[label, np.unique(words.word[own])] += 1
            off = np.arange(int(sizes[own].sum())) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
            seen_gram[label, np.unique(words.gram[np.repeat(words.gram_first[own], sizes[own]) + off])] += 1
        windows, owner = words.windows()
        words.gram = words.gram.astype(np.int32)
        chunks.append((a, words, windows.astype(np.int32), owner))
    d = CHAR_DIM + WORD_DIM
    small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    model = {"char": (rng.standard_normal((TABLE, CHAR_DIM)) * 0.02).astype(np.float32),
             "word": (rng.standard_normal((TABLE, WORD_DIM)) * 0.02).astype(np.float32),
             "attend": small(2 * HIDDEN), "out": small(2 * HIDDEN), "bias": np.zeros(1, dtype=np.float32)}
    model["char"][:, 0] = 0.25 * _odds(seen_gram, y.mean())
    model["word"][:, 0] = _odds(seen_word, y.mean())
    for side in "fb":
        model |= {"w" + side: small(d, 3 * HIDDEN), "u" + side: small(HIDDEN, 3 * HIDDEN),
                  "b" + side: np.zeros(3 * HIDDEN, dtype=np.float32)}
        model["w" + side][[0, CHAR_DIM], 2 * HIDDEN:] += 0.5 * np.sign(model["out"][:HIDDEN] if side == "f" else model["out"][HIDDEN:])
        model["w" + side][[0, CHAR_DIM], :HIDDEN] += 0.5
    model["attend"] += 0.5 * model["out"]
    names = [k for k in model if k not in ("char", "word")]
    m1 = {k: np.zeros_like(v) for k, v in model.items()}
    m2 = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for epoch in range(EPOCHS):
        batches = []
        for a, words, windows, owner in chunks:
            if not len(windows):
                continue
            value = _forward(model, words.inputs(model), windows)
            mine = y[a + owner]
            order = np.lexsort((-value, owner))
            best = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
            rand = rng.permutation(np.flatnonzero(mine == 0))[:max(1, len(best) // 2)]
            pick = np.concatenate([best, rand])
            batches.append((words, windows[pick], mine[pick]))
        for k in rng.permutation(len(batches) * 4):
            words, windows, mine = batches[k // 4]
            part = np.arange(len(mine)) % 4 == k % 4
            if not part.any():
                continue
            windows, mine = windows[part], mine[part]
            inputs = words.inputs(model)
            logit, (w, keep, h, a, pooled, saves) = _forward(model, inputs, windows, trace=True)
            weight = np.where(mine == 1, 0.5 / max(1, (mine == 1).sum()), 0.5 / max(1, (mine == 0).sum()))
            g = ((_sigmoid(logit) - mine) * weight).astype(np.float32)
            grad = {"bias": g.sum(keepdims=True), "out": pooled.T @ g}
            gpool = g[:, None] * model["out"]
            ga = (h * gpool[None]).sum(axis=2)
            gs = a * (ga - (a * ga).sum(axis=0))
            grad["attend"] = np.einsum("tnd,tn->d", h, gs)
            gh = a[:, :, None] * gpool[None] + gs[:, :, None] * model["attend"]
            gin = np.zeros_like(inputs)
            for s, side in enumerate("fb"):
                gp, grad["u" + side] = _gru_back(gh[:, :, s * HIDDEN:(s + 1) * HIDDEN], saves[s], model["u" + side], keep)
                flat, at = gp.reshape(-1, 3 * HIDDEN), w.reshape(-1)
                flat, at = flat[at >= 0], at[at >= 0]
                grad["w" + side] = inputs[at].T @ flat
                grad["b" + side] = flat.sum(axis=0)
                np.add.at(gin, at, flat @ model["w" + side].T)
            step += 1
            for name in names:
                _adam(model[name], grad[name], m1[name], m2[name], step, 0.02)
            used = np.unique(w[w >= 0])
            _rows(model["word"], words.word[used], gin[used, CHAR_DIM:])
            sizes = np.append(words.gram_first[1:], len(words.gram))[used] - words.gram_first[used]
            off = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            _rows(model["char"], words.gram[np.repeat(words.gram_first[used], sizes) + off],
                  np.repeat(gin[used, :CHAR_DIM], sizes, axis=0))
    # set the zero of the logits where it parts the training texts best, in the middle of the gap
    model["empty"] = -6.0
    value = np.concatenate([logits(model, texts[a:a + 100]) for a in range(0, len(texts), 100)])
    order = np.argsort(value)
    positive = np.cumsum(y[order][::-1])[::-1]
    f1 = 2 * positive / (len(y) - np.arange(len(y)) + max(1, y.sum()))
    best = int(f1.argmax())
    low = value[order[best - 1]] if best else value[order[0]] - 1
    model["bias"] -= np.float32((low + value[order[best]]) / 2)
    return model


def _adam(v, g, a, b, step, rate):
    a += 0.1 * (g - a)
    b += 0.01 * (g * g - b)
    v -= (rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)).astype(v.dtype)


def _rows(table, at, grad, rate=0.05):
    """A plain gradient step on the rows in use."""
    np.subtract.at(table, at, rate * grad)


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict | None:
    """Fit on the at most ``SAMPLE`` rows of ``labelled`` whose key has the least hash.

    Where fewer than ``CLASS_ROWS`` of either label are among them, the next
    ones of that label join. Equal rows are sampled once; longer texts and rows
    without key, text or label are not sampled. With rows of one label only
    there is nothing to learn and the model is None; labelled rows of both
    that can't be sampled (too long, without text) raise a ValueError.
    """
    have = labelled.columns
    text_hash = F.col("text_hash") if "text_hash" in have else F.xxhash64(text)
    chars = F.col("text_chars") if "text_chars" in have else F.length(text)
    known = labelled.where(F.col(label).isNotNull()).withColumn("y", (F.col(label) > 0).cast("int"))
    usable = known.where(F.col(key).isNotNull() & (chars <= SAMPLE_CHARS))
    place = F.struct(F.xxhash64(F.col(key).cast("string")), F.col(key), text_hash)
    narrow = usable.select(place.alias("place"), "y").distinct()
    edge = narrow.orderBy("place").limit(SAMPLE).agg(F.max("place").alias("place")).first()[0]
    if edge is None:
        return None

    kinds = [f.dataType for f in narrow.schema["place"].dataType.fields]

    def upto(last):
        return place <= F.struct(*[F.lit(v).cast(k) for v, k in zip(last, kinds)])
    chosen, furthest = upto(edge), edge
    for y in (0, 1):
        last = narrow.where(F.col("y") == y).orderBy("place").limit(CLASS_ROWS).agg(F.max("place")).first()[0]
        if last is not None:
            chosen, furthest = chosen | ((F.col("y") == y) & upto(last)), max(furthest, last)
    # the bound on keys alone goes below a join with the labels, so only sampled texts go through it
    rows = sorted(usable.where(upto(furthest)).where(chosen).select(F.col(key).alias("k"), F.col(text).alias("t"), "y").distinct().collect())
    labels = [int(r["y"]) for r in rows]
    if 0 < sum(labels) < len(labels):
        return fit([r["t"] for r in rows], labels)
    if known.select("y").distinct().count() > 1:
        raise ValueError(f"no labelled text of up to {SAMPLE_CHARS} characters for one of the labels")
    return None


def score(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, from its whole text alone.

    A null, empty or wordless text scores near 0; without a model every text
    scores 0. Repeated rows repeat; an empty table gives an empty result;
    other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # 2 * TABLE short rows, whatever the corpus

    def run(keys, texts):
        if shared.value is None:
            return [keys, np.zeros(len(texts))]
        return [keys, _sigmoid(logits(shared.value, texts).astype(np.float64))]

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text, run,
                     f"{key} long, score double", batch_bytes=1 << 20)


def drop_rejected(docs: DataFrame, model: dict | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``least``, as they are, judged where they stand.

    Null and wordless texts and, without a model, all rows stay.
    """
    scratch_root(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            if shared.value is None:
                yield batch
                continue
            column = batch.column(at).cast(pa.string())
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            part = (sizes.cumsum() - sizes) // (1 << 19)
            cuts = [0, *(part[1:] != part[:-1]).nonzero()[0] + 1, len(part)]
            scores = [_sigmoid(logits(shared.value, column.slice(a, b - a).to_pylist()).astype(np.float64))
                      for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < least))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def labelled_part(docs: DataFrame, labels: DataFrame, fold: int = 5) -> DataFrame:
    """(doc_id, text, toxic, text_hash, text_chars) of the labelled rows outside the held-out fold.

    Of several labels for a doc_id the largest counts; null labels and rows
    without doc_id have none.
    """
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.length("text").alias("text_chars"))
    return (rows.join(marks, "doc_id")
            .where(F.crc32(F.col("doc_id").cast("string")) % fold != 0))
