"""Operators with a learned model: toxicity, personal data, suffix tree."""

import math
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import pii, suffix_tree, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Toxicity


def test_folding():
    assert toxicity.fold("1d10t!!").split() == ["idiot"]
    assert toxicity.fold("sсum, $cum ｓcum ścum").split()[:3] == ["scum"] * 3
    assert toxicity.fold("Stop! now") .split() == ["stop", "now"]
    assert toxicity.fold(None).split() == []


def test_exceptions_and_beginnings():
    lexicon = toxicity.Lexicon([(" clown ", 2.0), (" idio", 3.0), (" idiots ", 1.0)], ["clown fish"])
    assert sum(lexicon.hits(toxicity.joined("a clown fish, a Clown and idiots")[0]).values()) == 5.0
    assert toxicity.Lexicon([]).hits(" clown ") == {}


@pytest.fixture
def labelled(spark, documents):
    rng = random.Random(11)
    words = [a + b for a in ("ka", "lo", "mi", "nu") for b in ("ba", "de", "fi", "go")]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 5 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(10, 80))]
        if toxic:
            for _ in range(1 + len(text) // 30):
                text.insert(rng.randrange(len(text)), rng.choice(["grumbo", "GRUMB0", "zarkly", "zarklish"]))
        elif k % 7 == 0:
            text += ["grumbo", "pie"]
        rows.append((k, " ".join(text)))
        labels.append((k, None if k == 7 else int(toxic)))
    rows += [(900, None), (901, ""), (902, rows[0][1] * 300), (None, rows[0][1]), (3, rows[3][1])]
    return documents(rows), spark.createDataFrame([*labels, (0, 0), (None, 1)], "doc_id long, toxic int"), {k for k, t in labels if t}


def test_held_out_rows_are_told_apart(labelled):
    documents, labels, toxic = labelled
    model = toxicity.train(documents, labels, toxicity.learned_rows())
    rows = toxicity.score_documents(documents, model).withColumn("learned", toxicity.learned_rows()).collect()
    assert len(rows) == 405
    scores = defaultdict(list)
    for r in rows:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and r["doc_id"] < 400 and not r["learned"]:
            scores[r["doc_id"] in toxic].append(r["score"])
    hits = sum(x >= toxicity.THRESHOLD for x in scores[True])
    false = sum(x >= toxicity.THRESHOLD for x in scores[False])
    assert hits >= 0.9 * len(scores[True]) and false <= 0.05 * len(scores[False])
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[900] == by_id[901] < toxicity.THRESHOLD <= by_id[902]


def test_toxic_documents_go(labelled):
    documents, labels, toxic = labelled
    kept = toxicity.drop_toxic(documents, labels)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == documents.columns and len(toxic & ids) <= 0.1 * len(toxic) and {900, 901, 3} <= ids


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score_documents(documents([(1, "x")]), toxicity.train(documents([]), none, F.lit(True))).collect()] == [0.0]


# Personal data


@pytest.fixture(scope="module")
def field():
    return pii.train()


def brute_viterbi(field, scores):
    best = scores[0] + np.where(pii.FIRST, 0.0, pii.NEVER)
    back = []
    for e in scores[1:]:
        reached = best[:, None] + field.move
        back.append(reached.argmax(0))
        best = reached.max(0) + e
    path = [int(best.argmax())]
    for origin in reversed(back):
        path.append(int(origin[path[-1]]))
    return path[::-1]


def test_the_labelled_table_is_learned(field):
    for words, tags in pii.parsed(pii.LABELLED):
        scores = field.scores(pii.features_of(words))
        assert brute_viterbi(field, scores) == tags
        assert pii.viterbi(field, [scores], [(True, True)])[0].tolist() == tags


def test_held_out_sentences(field):
    text = "call 555-0177 or (212) 555-0188 now, mail joe@box or ann@mail.example.com; host 10.1.2.3, card 4111-1111-1111-1111. In 2004 he had 17 of 3.5"
    found = [(pii.KINDS[k], text[s:e]) for k, s, e in pii.Tagger(field).added([text], [[]])[0]]
    assert found == [("phone", "555-0177"), ("phone", "(212) 555-0188"), ("email", "joe@box"), ("email", "ann@mail.example.com"),
                     ("ip", "10.1.2.3"), ("card", "4111-1111-1111-1111")]


def test_cutting_the_chain_changes_nothing(field):
    rng = random.Random(2)
    bits = ["word", "plain", "x", "555-0123", "(212)", "a@b", "10.0.0.1", "+1", "4111", "1111", "2019", "call", "9"]
    texts = [" ".join(rng.choice(bits[:3] if rng.random() < p else bits) for _ in range(rng.randrange(40))) for p in (0, 0.5, 0.9) for _ in range(150)]
    whole = pii.Field(field.names, field.emit, field.move)
    whole.reach = None
    assert field.reach is not None
    none = [[]] * len(texts)
    assert pii.Tagger(field).added(texts, none) == pii.Tagger(whole).added(texts, none)


def test_base_spans():
    text = "a.b@c.de x@y 1.2.3.256 1.2.3.4 4111 1111 1111 1111 4111111111111112 +49 (30) 123-456 +1 23"
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in pii.base_spans(text)] == [
        ("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+49 (30) 123-456")]
    assert [text for text in ("9" * 6000 + ".1.1.1", "") if pii.base_spans(text)] == []
    assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans("é 4111-1111-1111-1111é")] == [("card", 2, 21)]


CONTRACT = {  # the patterns as the contract gives them
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def contract_holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return kind == "email" or all(int(x) <= 255 for x in text.split("."))


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "a", "b1", "-", "+", " ", "1", "25", "300", "4111111111111111", "(", "%", "é", "\n", "a@b.c", "1.2.3.4"]), max_size=30).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    want = [
        (k, m.start(), m.end())
        for k, kind in enumerate(pii.KINDS) for m in re.finditer(CONTRACT[kind], text) if contract_holds(kind, m[0])
    ]
    assert pii.base_spans(text) == want


@pytest.mark.parametrize("text", ["7" * 1_000_000, "a" * 1_000_000 + " x@", "a.%" * 300_000 + "@ @", "1." * 500_000, "1 " * 400_000, "+1" * 400_000, "a@" * 400_000])
def test_base_spans_of_long_runs(text):
    start = time.process_time()
    pii.base_spans(text)
    assert time.process_time() - start < 4


def test_memory_of_many_numbers():
    """A page of figures beside short texts: stretches of like length are decoded together."""
    rng = random.Random(2)
    tagger = pii.Tagger(pii.train(pii.LABELLED))
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(20_000))] + ["call 555-0123 now please", "no 7"] * 2_500
    tracemalloc.start()
    together = tagger.added(texts, [[] for _ in texts])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    assert together[1:3] == tagger.added(texts[1:3], [[], []]) and together[:1] == tagger.added(texts[:1], [[]])


def test_spans_that_meet():
    rng = random.Random(6)
    for _ in range(300):
        spans = [(0, a := rng.randrange(30), a + rng.randrange(1, 8)) for _ in range(rng.randrange(6))]
        s = rng.randrange(30)
        e = s + rng.randrange(1, 8)
        assert pii.Taken(spans).meets(s, e) == any(a < e and s < b for _, a, b in spans)


def test_base_spans_stay(documents, corpus):
    rows = [(1, "call 555-0177, a@b.co"), (2, None), (3, ""), (4, "1.2.3.4"), (4, "1.2.3.4"), *corpus]
    got = {(r["doc_id"], len(r["base"]), len(r["added"])) for r in pii.find_pii(documents(rows)).collect()}
    assert {(1, 1, 1), (2, 0, 0), (3, 0, 0), (4, 1, 0)} <= got
    assert pii.find_pii(documents([])).count() == 0


# Suffix tree


def tokens_of(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return WORD.findall(lowered) + [None]


class BruteTree:
    """The same model with dictionaries."""

    def __init__(self, texts, least, depth):
        self.count = [Counter() for _ in range(depth + 1)]
        sequences = [["<s>", *tokens_of(t)] for t in texts]
        for s in sequences:
            self.count[0].update((w,) for w in s)
        self.total = sum(n for w, n in self.count[0].items() if w != ("<s>",))
        self.distinct = len([w for w in self.count[0] if w != ("<s>",)])
        self.all = Counter({w[0]: n for w, n in self.count[0].items()})
        self.count[0] = Counter({w: n for w, n in self.count[0].items() if n >= least})
        for k in range(1, depth + 1):
            for s in sequences:
                for i in range(k, len(s)):
                    gram = tuple(s[i - k : i + 1])
                    if gram[:-1] in self.count[k - 1] and gram[1:] in self.count[k - 1]:
                        self.count[k][gram] += 1
            self.count[k] = Counter({g: n for g, n in self.count[k].items() if n >= least})
        self.nodes = {}
        for k in range(1, depth + 1):
            listed = defaultdict(dict)
            for gram, n in self.count[k].items():
                listed[gram[:-1]][gram[-1]] = n
            for context, following in listed.items():
                seen = self.count[k - 1][context]
                own = {w: (n - suffix_tree.DISCOUNT) / seen for w, n in following.items()}
                shorter = {w: self.probability(context[1:], w) for w in following}
                left, left_shorter = 1 - sum(own.values()), 1 - sum(shorter.values())
                if left <= 1e-12 or left_shorter <= 1e-12:
                    continue
                gain = sum(own[w] * math.log(own[w] / shorter[w]) for w in own) + left * math.log(left / left_shorter)
                if seen * gain >= suffix_tree.DIVERGENCE * (len(own) + 1):
                    self.nodes[context] = own, left / left_shorter

    def probability(self, context, word):
        if not context:
            return (self.all[word] + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        if context in self.nodes:
            own, rest = self.nodes[context]
            return own[word] if word in own else rest * self.probability(context[1:], word)
        return self.probability(context[1:], word)

    def score(self, text, depth):
        s = ["<s>", *tokens_of(text)]
        return sum(math.log10(self.probability(tuple(s[max(0, i - depth) : i]), s[i])) for i in range(1, len(s)))


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_scores_as_brute_force(documents, corpus, depth):
    rows = [*corpus, (80, corpus[45][1] + " unseen words here")]
    held = F.col("doc_id") % 5 == 0
    got = suffix_tree.score_documents(documents(rows), held, depth=depth).collect()
    training = [t for i, t in rows if i is not None and i % 5]
    tree = BruteTree(training, suffix_tree.LEAST, depth)
    assert tree.nodes and len(got) == len(rows)
    expected = [
        (i is None or i % 5 == 0, len(tokens_of(t)), sum(tree.all[w] > 0 for w in tokens_of(t)),
         round(sum(math.log10(tree.probability((), w)) for w in tokens_of(t)), 5), round(tree.score(t, depth), 5))
        for i, t in rows
    ]
    plain = [(r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in got]
    assert sorted(plain) == sorted(expected) and {r["train_tokens"] for r in got} == {tree.total}


@pytest.mark.parametrize("head, bucket", [(60, 1000), (0, 300)])
def test_sequences_count_at_every_size(monkeypatch, documents, corpus, head, bucket):
    """What is broadcast decides nothing: rarer sequences score in buckets."""
    monkeypatch.setattr(suffix_tree, "BUCKET", bucket)
    held = F.col("doc_id") % 5 == 0
    got = suffix_tree.score_documents(documents(corpus), held, head=head).collect()
    tree = BruteTree([t for i, t, *_ in corpus if i is not None and i % 5], suffix_tree.LEAST, suffix_tree.DEPTH)
    expected = [(len(tokens_of(t)), round(tree.score(t, suffix_tree.DEPTH), 5)) for _, t, *_ in corpus]
    assert sorted((r["n_tokens"], round(r["score"], 5)) for r in got) == sorted(expected)
    assert sum(r["score"] > r["base_score"] + 1 for r in got) > 20


def test_probabilities_after_a_context_add_up(corpus):
    tree = BruteTree([t for _, t in corpus], suffix_tree.LEAST, 2)
    words = [w for w in tree.all if w != "<s>"]
    for context in [(), *list(tree.nodes)[:20]]:
        unknown = tree.probability(context, "not there")
        assert sum(tree.probability(context, w) for w in words) + unknown == pytest.approx(1)


def test_nothing_to_learn(documents):
    assert suffix_tree.score_documents(documents([]), F.lit(False)).count() == 0
    row = suffix_tree.score_documents(documents([(1, "a b"), (2, None)]), F.lit(True)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in row] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]


def test_marks_surround_each_text():
    tokens, first = suffix_tree.marked(np.array([7, 8, 9], np.uint64), np.array([2, 0, 1]))
    assert tokens.tolist() == [1, 7, 8, 2, 1, 2, 1, 9, 2] and first.tolist() == [0, 4, 6]


def test_numbers_are_counted_and_found_as_numpy_does():
    numbers = np.random.default_rng(7).integers(0, 500, 5000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key, place, n = suffix_tree.distinct(numbers)
    assert (key == np.unique(numbers)).all() and (numbers[place] == key).all() and n.sum() == len(numbers)
    assert (n == np.unique(numbers, return_counts=True)[1]).all()
    assert [len(x) for x in suffix_tree.distinct(numbers[:0])] == [0, 0, 0]
    at = suffix_tree.find(key[::2], numbers)
    assert (at >= 0).tolist() == np.isin(numbers, key[::2]).tolist() and (key[::2][at[at >= 0]] == numbers[at >= 0]).all()
