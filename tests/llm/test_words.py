import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import words as w


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("piece", [5, 64, 1 << 20])
@pytest.mark.parametrize(
    "separators, pattern",
    [(w.WHITESPACE, r"[^\x20\x09-\x0D]+"), (w.NOT_ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")],
)
def test_words_as_a_pattern_finds_them(monkeypatch, piece, separators, pattern):
    monkeypatch.setattr(w, "PIECE", piece)
    monkeypatch.setattr(w, "_powers", [np.ones(1, np.uint64)] * 2)
    rng = random.Random(piece)
    seen = {}
    for _ in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("aAbZ \t\n.\x0bé9ß\x00-") for _ in range(rng.choice((0, 1, 5, 40, 200)))) for _ in range(rng.randrange(9))]
        numbers, counts = w.words(pa.array(texts, pa.string()), w.byte_values(separators))
        expected = [re.findall(pattern, lowered(t)) for t in texts]
        assert counts.tolist() == [len(e) for e in expected]
        for word, number in zip([x for e in expected for x in e], numbers.tolist(), strict=True):
            assert seen.setdefault(word, number) == number
    assert len(set(seen.values())) == len(seen)


def test_sliced_arrays_and_slices():
    texts = pa.array(["x y", "a b c", None, "d"])
    numbers, counts = w.words(texts.slice(1), w.byte_values(w.WHITESPACE))
    assert counts.tolist() == [3, 0, 1] and len(numbers) == 4
    assert list(w.slices(np.array([3, 0, 9, 1, 1]), 4)) == [(0, 2), (2, 3), (3, 5)]
