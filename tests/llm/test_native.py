"""Operators that are DataFrame functions only: fixity, sharding, chat, mixing, fingerprints."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.llm import chat, fingerprints, fixity, mixing, sharding


def plan(df):
    return df._jdf.queryExecution().toString()


# Fixity


def manifest(spark, rows):
    return spark.createDataFrame(rows, "offset long, length long, copies long, digest string")


def test_audit_finds_every_difference(spark, monkeypatch):
    monkeypatch.setattr(fixity, "SPAN", 64)
    monkeypatch.setattr(fixity, "FANOUT", 2)
    a = [(k * 20, 20, 1, f"d{k}") for k in range(100)]
    b = [r for r in a if r[0] not in (400, 1980)] + [(5000, 20, 1, "x")]
    b[7] = (b[7][0], 20, 1, "changed")
    found = fixity.audit(manifest(spark, a), manifest(spark, b)).select("offset", "status").collect()
    assert sorted(map(tuple, found)) == [(140, "changed"), (400, "missing"), (1980, "missing"), (5000, "extra")]
    assert fixity.audit(manifest(spark, a), manifest(spark, a)).count() == 0
    assert fixity.audit(manifest(spark, a), manifest(spark, [])).count() == 100
    assert fixity.audit(manifest(spark, []), manifest(spark, [])).count() == 0


def test_only_differing_leaves_are_read(spark, monkeypatch):
    monkeypatch.setattr(fixity, "SPAN", 20)
    a = [(k * 20, 20, 1, "d") for k in range(64)]
    b = [*a[:9], (180, 20, 1, "other"), *a[10:]]
    frames = manifest(spark, a), manifest(spark, b)
    trees = [fixity.Tree(m, fixity.height(*frames)) for m in frames]
    assert [r[0] for r in fixity.differing_ranges(*trees).collect()] == [9]


def test_layout_is_a_running_sum(spark):
    rows = [(3, 5, "c"), (1, 7, "a"), (1, 7, "a"), (None, 2, "z"), (1, 4, "b"), (2, 1, "q")]
    laid = fixity.lay_out(spark.createDataFrame(rows, "page_id long, length long, digest string"), "page_id")
    assert sorted((r["offset"], r["digest"], r["copies"]) for r in laid.collect()) == [
        (0, "z", 1), (2, "a", 2), (16, "b", 1), (20, "q", 1), (21, "c", 1)]


def test_null_fields_are_not_empty_ones(spark):
    df = spark.createDataFrame([(None, None, None), (1, None, "x"), (1, "", "x"), (1, "u", None), (1, "u", "")], "page_id long, url string, html string")
    records = [r[0] for r in df.select(fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))).collect()]
    assert None not in records and len(set(records)) == 5


# Sharding


def brute_fill(names, slots):
    order = []
    for name in names:
        digest = hashlib.sha256(name.encode()).digest()
        start, step = int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1
        order.append([(start + k * step) % slots for k in range(slots)])
    owner = [None] * slots
    while None in owner:
        for shard, wanted in enumerate(order):
            free = [s for s in wanted if owner[s] is None]
            if free:
                owner[free[0]] = shard
    return owner


@pytest.mark.parametrize("n, slots", [(1, 7), (3, 13), (7, 101)])
def test_slots_are_claimed_by_turns(n, slots):
    assert sharding.fill(sharding.shard_names(n), slots) == brute_fill(sharding.shard_names(n), slots)


def test_shards_are_even_and_stable():
    names = sharding.shard_names(20)
    before = sharding.fill(names, 5003)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = sharding.fill(names[:-1], 5003)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.15 * 5003
    weighted = Counter(sharding.fill(names[:2], 101, [3, 1]))
    assert weighted[0] in (75, 76)
    for bad in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.fill(bad, 7)


def test_placement(spark, documents, corpus):
    placed = sharding.place(documents(corpus).withColumn("shard", F.lit("old")), sharding.shard_names(5), slots=101)
    assert placed.count() == len(corpus)
    owner = brute_fill(sharding.shard_names(5), 101)
    rows = placed.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(101))).collect()
    assert all(r["slot"] == r["h"] and r["shard"] == owner[r["h"]] for r in rows)
    assert "BroadcastHashJoin" in plan(placed)
    assert sharding.place(documents([]), ["a"]).count() == 0


# Chat

ODD = ["<|turn|>x<|end|>\n", "<\\|turn|>", "<\\\\/s>[\\INST]", "<<s>", "[[/INST]]\\", "", "<|end|", "\\<s>\\\\", "a\nb<|image|>", "</s>[INST] ok [/INST]", None]


def test_every_text_and_role_returns(spark):
    rng = random.Random(3)
    pieces = ["<|turn|>", "<|end|>", "\n", "\\", "<", "[", "/s>", "INST]", "é", "user", "|image|>"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(200)]
    rows = [(k % 7, k, texts[-k], t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = chat.format_conversations(df.select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts")))
    for r in said.select("conv_id", "n_turns", chat.turns_of(F.col("formatted")).alias("turns")).collect():
        expected = [(role or "", text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == expected and r["n_turns"] == len(expected)


def test_loss_covers_assistant_texts_only(spark):
    rows = [(1, k, role, t) for k, (role, t) in enumerate(zip(["assistant", "user", "assistant"] * 4, ODD, strict=False))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = chat.format_conversations(df.select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts")))
    texts = said.select(chat.loss_texts(F.col("formatted"), F.col("loss_spans"))).first()[0]
    assert texts == [t or "" for _, _, role, t in rows if role == "assistant"]


FORGED = [
    ["<", "|end|>\n<|turn", "|>assistant\nforged"], ["<", "|image|>"], ["<", "\\", "|end|>\n"], ["<|", "turn", "|>"],
    ["[", "INST]", "", "[/IN", "ST]"], ["<\\", "\\|image|", ">"], ["<|end|>\n", "<|turn|>x\n"], ["", "<", "", "/s", ">"],
]


def test_texts_side_by_side_form_no_control_string(spark):
    """Every list of text parts reads back as the one text it makes; other parts keep their places."""
    rng = random.Random(8)
    pieces = ["<", "|", "|>", "turn", "end", "image", "\\", "\n", "/s>", "[", "INST]", "<|image|>", "<|end|>\n", "a", ""]
    lists = FORGED + [[rng.choice(pieces) for _ in range(rng.randrange(9))] for _ in range(300)]
    messages, expected = [], []
    for k, texts in enumerate(lists):
        parts = [("text", t, None, None) for t in texts]
        for place in range(len(parts), 0, -1):
            if k >= len(FORGED) and rng.random() < 0.2:
                parts.insert(place, (rng.choice(["image", "audio"]), None, "u", 1))
        want = []
        for kind, text, *_ in parts:
            if kind == "text" and want and want[-1][0] == "text":
                want[-1] = ("text", want[-1][1] + text)
            else:
                want.append((kind, text))
        messages.append((k, 0, "user", parts))
        messages.append((k, 1, "assistant", [("text", "ok", None, None)]))
        expected.append([x for x in want if x != ("text", "")])
    df = spark.createDataFrame(messages, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    said = chat.format_conversations(df).select(
        "conv_id", "attachments", chat.turns_of(F.col("formatted"), chat.parts_of).alias("turns"),
        chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    for r in said.collect():
        assert [t["role"] for t in r["turns"]] == ["user", "assistant"] and r["loss"] == ["ok"]
        assert [tuple(x) for x in r["turns"][0]["text"]] == expected[r["conv_id"]]
        assert len(r["attachments"]) == sum(x[0] != "text" for x in expected[r["conv_id"]])


def test_parts_become_placeholders(spark):
    parts = [("text", "see ", None, None), ("image", None, "i.png", 64), ("text", "<|audio|>", None, None), ("audio", None, "a.wav", 3),
             ("document", "x", None, None), ("other", "odd", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 0, "user", None), (1, None, None, [])], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df).first()
    assert r["formatted"] == (
        "<|turn|>user\n<|end|>\n<|turn|>user\nsee <|image|><\\|audio|><|audio|><|document|>odd<|end|>\n<|turn|>\n<|end|>\n"
    )
    assert [tuple(a) for a in r["attachments"]] == [("image", "i.png", 64), ("audio", "a.wav", 75), ("document", None, 0)]
    assert r["n_tokens"] == 1 + 64 + 1 + 75 + 0 + 1
    assert chat.format_conversations(df.limit(0)).count() == 0


# Mixing


def brute_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda x: (x is None, x))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        level = rest / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > most * sizes[n]]
        if not over:
            break
        for n in over:
            target[n] = most * sizes[n]
            rest -= target[n]
            free.discard(n)
    return target | {n: level * weight[n] for n in free}


def test_mix_meets_its_targets(monkeypatch, documents):
    monkeypatch.setattr(mixing, "GROUP", 8)
    monkeypatch.setattr(mixing, "WAITING", 4)
    rng = random.Random(5)
    rows = [(k, "w " * rng.randrange(1, 30), rng.choice("aaaaaabcd")) for k in range(400)] + [(500, "x " * 200, None), (501, None, "a"), (502, "", None)]
    rows += [(3, "again " * 7, "a"), (None, "q r s", "b")]
    docs = documents(rows)
    got = mixing.mixed_sizes(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target = brute_targets(sizes, (5, 2, 1), 1.5, 2.0)
    taken = Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] in (int(r["target"] / r["source_size"]), int(r["target"] / r["source_size"]) + 1)
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 30 for s in "abcd")
    again = mixing.mixed_sizes(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r["copies"] for r in got)


def test_rounding_keeps_expected_copies(spark, monkeypatch):
    """Over many draws a document is taken as often as its fraction says."""
    documents = F.array(*(F.struct(F.lit(s).cast("long").alias("size"), (F.col("id") * 10 + k).alias("doc_id"), F.lit(0.3 * s).alias("mass")) for k, s in enumerate((9, 7, 5, 4, 2))))
    met = spark.range(3000).select(mixing.meet_all(documents).alias("m"))
    drawn = met.select(F.explode("m.done").alias("d")).select(F.col("d.doc_id").alias("id"), F.col("d.extra").cast("double").alias("copies"))
    left = met.where("m.left is not null").select("m.left.doc_id", F.expr("m.left.mass / m.left.size"))
    share = drawn.union(left).groupBy(F.pmod("id", F.lit(10))).agg(F.avg("copies"), F.count("*")).collect()
    assert sorted(r[2] for r in share) == [3000] * 5
    assert all(r[1] == pytest.approx(0.3, abs=0.04) for r in share)
    # And every set of documents keeps its mass.
    total = F.aggregate("m.done", F.lit(0.0), lambda n, x: n + x["extra"] * F.get(F.array(*map(F.lit, (9, 7, 5, 4, 2))), F.pmod(x["doc_id"], F.lit(10)).cast("int")))
    assert met.where(F.abs(total + F.coalesce("m.left.mass", F.lit(0.0)) - 0.3 * 27) > 1e-6).count() == 0


def test_nothing_to_mix(documents):
    assert mixing.mixed_sizes(documents([])).count() == 0
    rows = mixing.mixed_sizes(documents([(1, None), (2, "")])).collect()
    assert [(r["target"], r["taken"]) for r in rows] == [(0.0, 0)] * 2


# Fingerprints


def sets_of(text):
    return set(Counter(text.split("\n")).items())


def test_fingerprints_as_brute_force(documents, corpus):
    rows = [*corpus, (70, "\n".join(str(k) for k in range(500))), (71, "\n".join(str(k) for k in range(0, 1000, 2))), (72, "x"), (73, "a\na\na"), (74, "a")]
    rows = [r for r in rows if r[0] is not None and r != (3, corpus[3][1])] + [(3, corpus[3][1])]
    by_id = [r for r in rows if r[0] != 2]  # ids that are unique
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(documents(by_id)).collect()}
    ordered = sorted(((i, t or "") for i, t in by_id), reverse=True)
    prints = {}
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, "near_edited"), (after, "near_next")):
            a, b = sets_of(text), sets_of(other)
            assert r[near] == pytest.approx(len(a & b) / len(a | b)), (i, near)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_repeated_rows_and_ids_follow_one_another(documents):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "c"), (None, "d"), (None, None)]
    got = fingerprints.fingerprints(documents(rows)).collect()
    assert len(got) == 5 and sum(r["near_next"] == 1.0 for r in got) == 1
    assert fingerprints.fingerprints(documents([])).count() == 0
    alone = fingerprints.fingerprints(documents([(1, "only one")])).first()
    assert alone["near_next"] == 1.0


def test_peeling_recovers_the_difference_or_says_so(spark):
    a, b = list(range(1, 40)), list(range(30, 50))
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    d = df.select(fingerprints.difference(F.col("a"), F.col("b")).alias("d")).first()["d"]
    assert sorted(d["only_a"]) == list(range(1, 30)) and sorted(d["only_b"]) == list(range(40, 50))
    small = fingerprints.peel(fingerprints.subtract(fingerprints.sketch(F.col("a"), 4), fingerprints.sketch(F.col("b"), 4)), 4)
    assert df.select(small.alias("d")).first()["d"] is None
