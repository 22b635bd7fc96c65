import re
from collections import defaultdict

import pytest

from tradewind.llm import decontamination as d
from tradewind.llm import ngram_join as j
from tradewind.llm.components import components

WORD8 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD3 = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def root_of(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return find


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 2), (2, 9), (7, 8), (7, 7), (5, 2)], [(k, k + 1) for k in range(40)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    find = root_of(edges)
    own = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, components(df).collect())) == sorted((x, find(x)) for x in own)


def brute_join(rows, size, percent):
    sets = []
    for doc_id, text in rows:
        words = WORD3.findall(lowered(text))
        grams = frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()
        sets.append((doc_id, grams))
    links, degree = [], defaultdict(set)
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets):
            if a != b and x and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
                if x != y:
                    degree[a].add(y)
    find = root_of(links)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), (True, 0)), (doc_id is None, doc_id or 0))
    return [
        (doc_id, len(x), None if least[find(k)][0] else least[find(k)][1], len(degree[k])) if x else (doc_id, 0, doc_id, 0)
        for k, (doc_id, x) in enumerate(sets)
    ]


@pytest.mark.parametrize("size, percent, block", [(4, 85, 256), (5, 80, 4), (2, 60, 2)])
def test_join_as_brute_force(monkeypatch, documents, corpus, size, percent, block):
    monkeypatch.setattr(j, "BLOCK_SETS", block)  # several blocks in a cluster
    rows = [(a, b) for a, b, *_ in corpus]
    got = j.ngram_components(documents(rows), size, percent).collect()
    plain = sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "n_links")) for r in got), key=str)
    assert plain == sorted(brute_join(rows, size, percent), key=str)


def test_bins_grow_with_the_block_pairs(monkeypatch, documents):
    """80 near copies in blocks of two are some 800 block pairs: no bin has more than a few."""
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*base[:100], f"x{k}", *base[100:]])) for k in range(80)]
    plain = j.linked

    def bounded(percent):
        inner = plain(percent)

        def summed(table):
            units = len(set(table.column("unit").to_pylist()))
            if units > 40:
                raise ValueError(f"{units} block pairs in a bin")
            return inner(table)

        return summed

    monkeypatch.setattr(j, "linked", bounded)
    monkeypatch.setattr(j, "BLOCK_SETS", 2)
    monkeypatch.setattr(j, "BUCKET_UNITS", 8, raising=False)
    got = j.ngram_components(documents(rows)).collect()
    assert {(r["component_id"], r["n_links"]) for r in got} == {(0, 79)}


def test_one_of_each_component_stays(documents, corpus):
    docs = documents(corpus)
    kept = j.keep_one(docs, 4, 85)
    assert kept.columns == docs.columns
    ids = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(ids) == len(set(ids))
    found = brute_join(list(dict.fromkeys(corpus)), 4, 85)
    empty = sum(1 for r in found if not r[1])
    # Rows of one component share its smallest id; two texts under one id are two components here.
    assert len(ids) == empty + len({(r[2], r[1]) if r[0] in (2, None) and r[3] == 0 else r[2] for r in found if r[1]})


def test_nothing_to_join(documents):
    assert j.ngram_components(documents([])).count() == 0
    only = j.ngram_components(documents([(1, None), (2, ""), (3, "a b")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["keeper"]) for r in only) == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True)]


def brute_hits(text, items, width):
    words = WORD8.findall(lowered(text))
    hit, found = set(), set()
    for item, own in items:
        item_words = WORD8.findall(lowered(own))
        size = min(width, len(item_words))
        windows = {tuple(item_words[k : k + size]) for k in range(len(item_words) - size + 1)} if size else set()
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.fixture
def items(corpus):
    long = WORD3.findall(corpus[45][1])
    return [(1, " ".join(long[20:45])), (2, "ka-BA; xyz"), (3, corpus[1][1]), (4, ""), (5, None), (1, " ".join(long[100:110])),
            (7, " ".join(["kaba"] * 12)), (8, "never there at all " * 4)]


@pytest.mark.parametrize("segment, candidates, group", [(1 << 19, 1 << 21, 1 << 20), (100, 7, 10)])
def test_contamination_as_brute_force(monkeypatch, spark, documents, corpus, items, segment, candidates, group):
    monkeypatch.setattr(d, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(d, "CANDIDATES", candidates)
    monkeypatch.setattr(d, "ITEM_WORDS", group)
    rows = [*corpus, (90, "kaba " * 40), (91, "x KABA. \xffkaba ba xyz ka"), (92, "start ka ba xyz")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = d.contamination(documents(rows), frame, 5)
    plain = sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in got.collect()), key=str)
    assert plain == sorted(((x[0], *brute_hits(x[1], items, 5)) for x in rows), key=str)
    clean = d.decontaminate(documents(rows), frame, 5)
    assert clean.count() == sum(not brute_hits(x[1], items, 5)[1] for x in rows)


def test_proximity(spark, documents):
    docs = documents([(1, "a x b y c"), (2, "c b a"), (3, "a x x x b c"), (4, "a b"), (5, "a c a b q c b a")])
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rows, found = d.matches(docs, items, 3, within=5)
    near = found.join(rows, ["segment", "place"]).select("doc_id").distinct()
    assert sorted(r[0] for r in near.collect()) == [1, 2, 5]


def test_nothing_to_search(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(documents([]), none).count() == 0
    row = d.contamination(documents([(1, "a b")]), none).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (2, 0, [])
