"""Spelling variants against all pairs of words, letter by letter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def brute_counts(rows, every=199, length=6, least=5):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def edited_once(a, b):
    """One inserted, deleted or replaced code point, by trying."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_near(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [] for w in words}
    for w in words:
        for k in (-1, 0, 1):
            near[w] += [x for x in by_length.get(len(w) + k, []) if edited_once(w, x)]
    return near


def brute_variants(rows, **bounds):
    counts = brute_counts(rows, **bounds)
    near, form = brute_near(counts), {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def variants_of(rng, base, n):
    words = {base}
    while len(words) < n:
        w = rng.choice(sorted(words))
        k = rng.randrange(len(w) + 1)
        words.add(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcéÿ×") + w[k:], w[:k] + rng.choice("xyzà") + w[k + 1 :]]))
    return sorted(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = [w for base in ("caramel", "élégante", "strasse", "zzzzzzzz") for w in variants_of(rng, base, 40)]
    words += ["".join(rng.sample("abcdefg", 7)) for _ in range(120)] + ["Ab", "ÀÉ×÷ÿÀ"]
    out = []
    for k in range(150):
        out.append((k, " ".join(rng.choice(words[: rng.choice((5, 60, 400))]).replace("a", rng.choice("aA")) for _ in range(60))))
    out += [(3, out[3][1]), (3, "other text caramel"), (None, out[5][1]), (900, None), (901, ""), (902, "1 2 ＡＢ漢字Ÿ")]
    return out + [(903, "Caramels—caramels,caramels caramelsĀcaramels¿caramels" * 40), (904, "b" * 5000 + " " + "b" * 4999)] * 5


@pytest.mark.parametrize("every", [199, 2, 1])
def test_counts(spark, documents, rows, every):
    got = spelling.word_counts(documents(rows).repartition(3), every).collect()
    assert {r["word"]: r["n"] for r in got} == brute_counts(rows, every) and len(got) == len({r["word"] for r in got})


@pytest.mark.parametrize("cell, sample, askers", [(1 << 13, 200_000, 1 << 17), (20, 200_000, 60), (20, 150, 60), (3, 40, 10)])
def test_variants(spark, documents, rows, monkeypatch, cell, sample, askers):
    for name, value in (("CELL", cell), ("SAMPLE", sample), ("ASKERS", askers), ("LEAF", 4), ("BLOCK", 16), ("MATCHED", 200)):
        monkeypatch.setattr(spelling, name, value)
    got = spelling.variants(spelling.word_counts(documents(rows), 5)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_variants(rows, every=5))
    assert any(r["root"] not in (r["word"], r["form"]) for r in got)


def test_words_with_the_same_letters(spark, monkeypatch):
    """Anagrams fall in one leaf, whose points and askers are then dealt to several cells."""
    monkeypatch.setattr(spelling, "CELL", 50)
    monkeypatch.setattr(spelling, "ASKERS", 200)
    rng = random.Random(4)
    words = sorted({"".join(rng.sample(letters, 6)) for letters in ("abcdef", "abcdeg") for _ in range(600)})
    cells = spelling.Cells([w.encode() for w in words], 1.0)
    assert max(a * b for a, b in cells.parts.values()) > 4
    got = spelling.near_pairs(spark.createDataFrame([(w, 7) for w in words], "word string, n long")).collect()
    assert sorted((r["word"], r["near"]) for r in got) == sorted((w, x) for w, near in brute_near(words).items() for x in near)


def test_chains_of_forms(spark):
    chain = ["aaaaaa" + "b" * k for k in range(9)]
    words = spark.createDataFrame([(w, 5**k) for k, w in enumerate(chain, 1)], "word string, n long")
    got = {r["word"]: r for r in spelling.variants(words).collect()}
    assert {r["root"] for r in got.values()} == {chain[-1]} and got[chain[-1]]["form"] is None
    assert [got[w]["form"] for w in chain[:-1]] == chain[1:]


def test_no_words(spark, documents):
    assert spelling.variants(spelling.word_counts(documents([]))).collect() == []
    assert spelling.variants(spelling.word_counts(documents([(1, None), (2, "a b")]))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abcà", min_size=3, max_size=7), unique=True, min_size=1, max_size=60))
def test_near_words_of_small_alphabets(words):
    plain = [w.encode("latin-1") for w in words]
    by_length = {}
    for w in plain:
        by_length.setdefault(len(w), []).append(w)
    found = []
    for length, some in by_length.items():
        for longer in (0, 1):
            if length + longer in by_length:
                asking, points = spelling.Words(some), spelling.Words(by_length[length + longer])
                found += [(some[i], points.words[j]) for i, j in spelling.near_words(asking, points, longer)]
    pairs = [(a.decode("latin-1"), b.decode("latin-1")) for a, b in found]
    assert sorted(pairs + [(b, a) for a, b in pairs]) == sorted((w, x) for w, near in brute_near(words).items() for x in near)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aZé", min_size=1, max_size=90), min_size=1, max_size=20), st.lists(st.text("0127:", max_size=9), min_size=1, max_size=5))
def test_numbers(runs, prefixes):
    names = [p.encode() for p in prefixes]
    plain = pa.array([r.encode() for r in runs], pa.binary())
    owner, code = (x.ravel() for x in np.meshgrid(np.arange(len(names)), np.arange(len(runs))))
    got = spelling.numbers(names, plain, owner, code)
    assert got.tolist() == [zlib.crc32(names[a] + plain[int(b)].as_py()) for a, b in zip(owner, code, strict=True)]
