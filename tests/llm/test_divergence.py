"""The source divergence audit against whole loops over terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, least, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.add(key)
        words = terms_of(text)
        counts[key].update(words)
        docs[key[0]].update(set(words))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        every = {t: sum(c[t] for c in own.values()) for t in kept}

        def share(c, v=len(kept)):
            return {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * v) for t, n in c.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        p, q = {s: share(c) for s, c in own.items()}, share(every)
        for s in own:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            more = [(-f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out |= {(lang, s, part, item, -value, k) for k, (value, item) in enumerate(found, 1)}
    return out


def test_all_parts(spark, monkeypatch):
    rng = random.Random(5)
    words = [a + b for a in ("Ka", "lo", "mi", "ñu", "漢", "re") for b in ("ba", "de", "Éi", "go", "x")]
    rows = []
    for k in range(400):
        source = rng.choice(["a", "b", "c", None, "", "hot", "hot", "hot"])
        favourite = words[hash(source or "") % 7 :: 7] if source else words[::3]
        text = ", ".join(rng.choice(words if rng.random() < 0.5 else favourite) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "fr", None]), source, text if k % 20 else None))
    rows += [("xx", "a", "once only"), ("xx", "b", ""), ("yy", "a", None), ("en", "empty", ""), ("en", "hot", "loba " * 5000)]
    rows += [("en", "b", "Loba mide")] * 30
    frame = spark.createDataFrame([(*r, 1, 2, 3, "z") for r in rows], "lang string, source string, text string, n long, place long, p long, term string")
    for size in (divergence.HELD, 7):
        monkeypatch.setattr(divergence, "HELD", size)
        got = divergence.audit(frame.repartition(5))
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == brute(rows, divergence.LEAST, divergence.TERMS)


def test_nothing(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(none).collect() == []
    one = spark.createDataFrame([(None, None, None), ("en", "a", "w")], "lang string, source string, text string")
    assert divergence.audit(one).collect() == []


def test_documents_of_a_text_in_pieces():
    long = " ".join(["ab", "cd"] * 40 + ["ef"])
    texts = ["cd", long, "ab gh", None, "éA"]
    expected = Counter(t for x in texts for t in set(terms_of(x)))
    for size in (8, 50, 1 << 20):
        counts, documents = Counter(), Counter()
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(divergence, "PIECE", size)
            for terms, _, code, n, new in divergence.document_terms(pa.array(texts, pa.string())):
                for c, k, fresh in zip(code, n, new, strict=True):
                    term = terms[int(c)].as_py().decode()
                    counts[term] += int(k)
                    documents[term] += int(fresh)
        assert documents == expected and counts == Counter(t for x in texts for t in terms_of(x))


def test_tree_of_any_cut_of_the_rows():
    """Each row alone, all rows in one tree, and trees of parts give the same sums."""
    rng = np.random.default_rng(2)
    rows = sorted({tuple(sorted({(int(rng.integers(6)), int(rng.integers(1, 4)) * 1000, 7) for _ in range(4)})) for _ in range(60)})
    rows = [[x for k, x in enumerate(r) if all(x[0] != y[0] for y in r[:k])] for r in rows]
    rows = sorted(rows)

    def sums(parts):
        total = Counter()
        for part in parts:
            items = [x for r in part for x in r]
            at = np.r_[0, np.cumsum([len(r) for r in part])]
            columns = (np.array([x[k] for x in items], np.int64) for k in range(3))
            found = divergence.tree_corrections(np.zeros(len(part), np.int64), at, *columns, np.full(len(part), 3))
            for _, a, b, value in zip(*found, strict=True):
                total[int(a), int(b)] += int(value)
        return total

    assert sums([rows]) == sums([[r] for r in rows]) == sums([rows[:20], rows[20:37], rows[37:]])


def test_shares_are_exact(spark):
    totals = [(7, 9), (9 * 10**14, 9 * 10**15 - 1), (2, 10**15 + 3), (5, 5), (123456789, 987654321987)]
    frame = spark.createDataFrame(totals, "a long, b long")
    got = frame.select(divergence.share(frame["a"], frame["b"])).collect()
    assert [r[0] for r in got] == [1 + 10**9 * a // b for a, b in totals]
