"""Long texts keep their evidence."""

import functools

import numpy as np

from eventweave.llm import language


@functools.cache
def words_of(name):
    """The language's own large stock of words, and as many shared by all."""
    stock = np.random.default_rng(list(name.encode()))
    letters = list("abcdefghijklmnopqrstuvwxyz")
    odds = stock.dirichlet(np.full(26, 0.9))
    words = ["".join(stock.choice(letters, stock.integers(2, 9), p=odds)) for _ in range(20_000)]
    common = np.random.default_rng(0)
    words += ["".join(common.choice(letters, common.integers(2, 9))) for _ in range(20_000)]
    return words


def prose(name, size, seed):
    words = words_of(name)
    picks = np.random.default_rng(seed).integers(0, len(words), size // 6 + 10)
    return " ".join(words[k] for k in picks)[:size]


def test_a_megabyte_of_each_language():
    names = ["en", "de", "fr", "es"]
    texts = [prose(n, 2_000, k) for n in names for k in range(25)]
    model = language.fit(texts, [n for n in names for _ in range(25)])
    long = [prose(n, 1_000_000, 99) for n in names]
    assert language.predict(long, *model)[0] == names
    assert max(len(r) for r in language.presence(language.pieces(long[0]))) < language.COLUMNS // 4
    # the mean over pieces is near the score of one piece, however long the text
    short = language.predict([t[:20_000] for t in long], *model)[1]
    assert abs(language.predict(long, *model)[1] - short).max() < 0.1
    assert language.predict([], *model)[0] == []
