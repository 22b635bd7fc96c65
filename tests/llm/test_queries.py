"""The registered queries on the driver's smallest tables, against SQL or brute force, and the pipeline stage by stage."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from test_divergence import brute as brute_divergence
from test_models import BruteTree, tokens_of
from test_native import brute_targets, sets_of
from test_search_and_join import brute_hits, brute_join
from test_spelling import brute_variants

import corpus_pipeline
from tradewind.llm import ngram_join, pii, sharding, suffix_tree, toxicity
from tradewind.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not there")


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()


def by_id(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in read(spark, "documents")}


def test_one_query_each():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14)) and ORACLE.keys() <= QUERIES.keys()


def test_fixity_as_sql(spark):
    df = QUERIES["op1_merkle_fixity"](spark, FOLDER)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    found = con.execute(ORACLE["op1_merkle_fixity"])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = found.fetchall()
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(expected) and expected


def test_sharding(spark, docs):
    owner = sharding.fill(sharding.shard_names())
    got = by_id(spark, "op2_permutation_sharding")
    assert got.keys() == docs.keys()
    for i, r in got.items():
        slot = xxhash.xxh64(i.to_bytes(8, "little"), seed=42).intdigest()
        slot = (slot - (slot >> 63 << 64)) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, owner[slot])


def test_join(spark, docs):
    got = by_id(spark, "op3_ngram_jaccard_join")
    expected = brute_join([(i, r["text"]) for i, r in docs.items()], 4, 85)
    assert sorted(tuple(r) for r in got.values()) == sorted(expected)


def test_chat(spark):
    turns = defaultdict(list)
    for r in read(spark, "conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    hostile = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", hostile), (1, "assistant", hostile)]
    got = {r["conv_id"]: r for r in QUERIES["op4_chat_formatting"](spark, FOLDER).collect()}
    assert got.keys() == turns.keys()
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, role, t in rows if role == "assistant")
        lines = "".join(f"{role}\n{t}\n" for _, role, t in rows)
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(rows), hashlib.sha256(lines.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_mixing(spark, docs):
    got = by_id(spark, "op5_source_mixing")
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    total, taken, largest = Counter(), Counter(), Counter()
    for i, r in docs.items():
        total[r["source"]] += size[i]
        largest[r["source"]] = max(largest[r["source"]], size[i])
    target = brute_targets(total, (5, 2, 1), 1.5, 2.0)
    for i, r in got.items():
        source = docs[i]["source"]
        assert (r["size"], r["source_size"]) == (size[i], total[source]) and r["target"] == pytest.approx(target[source])
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in total)


def test_toxicity(spark, docs):
    got = by_id(spark, "op6_toxicity")
    assert got.keys() == docs.keys()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_toxicity_by_brute_force(spark):
    """The learned weights from counts of texts, and every score word by word, without an automaton."""
    folder = FOLDER.replace("sf0.001", "sf0.01")
    documents, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.train(documents, labels, toxicity.learned_rows())
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    learned: dict = {}
    for r in labels.collect():
        if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["doc_id"] in texts:
            text = texts[r["doc_id"]]
            learned[text] = max(learned.get(text, 0), int(r["toxic"] != 0))
    words = {t: toxicity.fold(t).split() for t in {*learned, *texts.values()}}

    def shows(entry, word):
        return word == entry.strip() if entry.endswith(" ") else word.startswith(entry[1:])

    sizes = Counter(learned.values())
    for entry, weight in model.entries[:60]:
        # A beginning is learned from longer words.
        least = max(3, len(entry) if entry[-1] != " " else 0)
        t, c = (
            0.5 + sum(k == toxic and any(len(w) >= least and shows(entry, w) for w in words[x]) for x, k in learned.items())
            for toxic in (1, 0)
        )
        odds = math.log(t / (sizes[1] + 1)) - math.log(c / (sizes[0] + 1))
        assert weight == pytest.approx(odds - math.sqrt(1 / t + 1 / c))

    excuses = [toxicity.fold(x).split() for x in model.exceptions]
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, folder).collect()}
    for i, text in texts.items():
        own = words[text]
        excused = {k + j for x in excuses for k in range(len(own) - len(x) + 1) if own[k : k + len(x)] == x for j in range(len(x))}
        best = [max((v for e, v in model.entries if shows(e, w)), default=None) for w in own]
        found = [v for k, v in enumerate(best) if v is not None and k not in excused]
        x = (1, math.log1p(sum(found)), math.log1p(100 * sum(found) / (len(own) + toxicity.PRIOR_WORDS)))
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.coefficients, strict=True))))
        assert (got[i]["n_hits"], got[i]["score"]) == (len(found), pytest.approx(score))


def test_toxicity_of_rows_not_learned_from(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scores = [[r["score"] for i, r in got.items() if labels.get(i) == k and r["held_out"]] for k in (0, 1)]
    better = sum((b > a) + (b == a) / 2 for a in scores[0] for b in scores[1])
    assert better / len(scores[0]) / len(scores[1]) > 0.95
    assert sum(x >= 0.3 for x in scores[1]) >= 0.8 * len(scores[1]) and sum(x >= 0.3 for x in scores[0]) <= 0.05 * len(scores[0])


def test_personal_data(spark, docs):
    got = by_id(spark, "op7_personal_data")
    for i, r in docs.items():
        base = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in sorted(pii.base_spans(r["text"] or ""))]
        listed = [x for x in got[i]["spans"].split(",") if x]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(listed) and len(listed) == len(base) + got[i]["n_added"]
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k) for x in base) for k in pii.KINDS]
        assert listed == sorted(listed, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_decontamination(spark, docs):
    items = [tuple(r) for r in read(spark, "benchmark")]
    got = by_id(spark, "op8_benchmark_decontamination")
    for i, r in docs.items():
        n, hit, found = brute_hits(r["text"], items, 10)
        names = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert tuple(got[i]) == (i, n, hit, len(found), names, hit > 0)


def test_fingerprints(spark, docs):
    got = by_id(spark, "op9_document_fingerprints")
    ordered = sorted(docs, reverse=True)
    for k, i in enumerate(ordered):
        text, after = docs[i]["text"] or "", docs[ordered[(k + 1) % len(ordered)]]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = sets_of(text), sets_of(edited), sets_of(after)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b)) and r["near_next"] == pytest.approx(len(a & c) / len(a | c))


def test_suffix_tree(spark, docs):
    got = by_id(spark, "op10_suffix_tree_score")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    tree = BruteTree([r["text"] for i, r in docs.items() if not held[i]], suffix_tree.LEAST, suffix_tree.DEPTH)
    for i, r in docs.items():
        words = tokens_of(r["text"])
        base = sum(math.log10(tree.probability((), w)) for w in words)
        assert tuple(got[i])[1:5] == (held[i], len(words), sum(tree.all[w] > 0 for w in words), tree.total)
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["score"] == pytest.approx(tree.score(r["text"], suffix_tree.DEPTH))
    for part in (True, False):  # the model beats its root on texts that it has not seen as well
        own = [r for i, r in got.items() if held[i] == part]
        assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)


def test_token_files(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = by_id(spark, "op11_token_files"), 0
    for i in sorted(docs):
        ids = [*tokenizer.encode(docs[i]["text"] or "", add_special_tokens=False).ids, 2]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)
    assert got.keys() == docs.keys()


def test_source_divergence(spark, docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.values()]
    got = {tuple(r) for r in QUERIES["op12_source_divergence"](spark, FOLDER).collect()}
    assert got == brute_divergence(rows, 10, 10)


def test_spelling_variants(spark, docs):
    got = [tuple(r) for r in QUERIES["op13_spelling_variants"](spark, FOLDER).collect()]
    want = brute_variants([(i, r["text"]) for i, r in docs.items()])
    assert len(got) > 100 and sorted(got) == sorted(want)


def test_pipeline_stage_by_stage(spark, docs):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, corpus_pipeline.written(stage(spark, frame, FOLDER), f"test-{name}")
        kept[name] = [r["doc_id"] for r in frame.collect()]
        if name != "sharding":
            assert frame.columns == columns
        rows = {r["doc_id"]: r["text"] for r in before.collect()}
        if name == "toxicity":
            score = by_id(spark, "op6_toxicity")
            assert sorted(kept[name]) == sorted(i for i in rows if not score[i]["predicted"])
        elif name == "near_duplicates":
            assert sorted(kept[name]) == sorted({r[2] for r in brute_join(list(rows.items()), 5, 80)})
        elif name == "decontamination":
            items = [tuple(r) for r in read(spark, "benchmark")]
            assert sorted(kept[name]) == sorted(i for i, t in rows.items() if not brute_hits(t, items, 10)[1])
        elif name == "mixing":
            assert max(Counter(kept[name]).values()) <= 2 and set(kept[name]) <= rows.keys()
        else:
            assert sorted(kept[name]) == sorted(kept["mixing"]) and set(frame.columns) - set(columns) == {"slot", "shard"}
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert all(docs[i]["text"] == t for i, t in texts.items())
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["doc_id"] for r in again.collect()) == sorted(kept["sharding"])


def test_pipeline_on_odd_rows(spark, documents, corpus, tmp_path):
    """Nulls, empty texts, repeated rows and columns with the operators' own names go through all stages; so does nothing."""
    folder = str(tmp_path)
    documents(corpus).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, corpus[4][1]), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert set(documents(corpus).columns) <= set(out.columns) and out.count() > 0
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_constants_of_the_contract():
    assert (ngram_join.SIZE, ngram_join.PERCENT, toxicity.THRESHOLD) == (4, 85, 0.3)
