"""Personal data in lines longer than a sequence."""

from eventweave.llm import pii


def test_spans_over_every_cut():
    hits = ["phone (212) 555-0199 now", "card number 5500 0000 0000 0001 was used", "ssn 123-45-6789 x"]
    for hit in hits:
        alone = f"plain words {hit} plain words"
        want = [alone[a:b] for a, _, b in pii.find([alone])[1][0]]
        assert want
        for before in range(pii.SEQUENCE_WORDS - 8, pii.SEQUENCE_WORDS + 2):
            text = "plain " * before + hit + " words" * 700
            assert [text[a:b] for a, _, b in pii.find([text])[1][0]] == want, (hit, before)


def test_overlapped_sequences_equal_whole_lines(monkeypatch):
    import random
    rng = random.Random(4)
    stock = "phone plain call (212) 555-0199 1999 +44 20 7946 a@b 4111 1111 x: of the 10:30 DE89370400440532013000".split()
    texts = [" ".join(rng.choice(stock) for _ in range(3000)) for _ in range(5)]
    got = pii.chain_spans(texts)
    monkeypatch.setattr(pii, "SEQUENCE_WORDS", 10_000)
    assert got == pii.chain_spans(texts) and all(got)


def test_shape_of_a_long_word():
    assert pii._shape("x" * 64 + "12345") != pii._shape("x" * 69)
