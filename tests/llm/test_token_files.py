"""Token files against texts encoded one by one, whole."""

import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import runs, token_files
from tradewind.llm.shared import new_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
END = 2


def vocabulary(name="byte_bpe_50k.json"):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def whole():
    tokenizer = token_files.encoder(vocabulary(), END).tokenizer
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]


def streamed(texts, size=None):
    import pyarrow as pa

    found, ends = [], []
    for tokens, behind in token_files.encoder(vocabulary(), END).stream(pa.array(texts, pa.string())):
        ends += (len(found) + behind).tolist()
        found += tokens.tolist()
    return [found[a:b] for a, b in zip([0, *ends], ends, strict=False)]


ALPHABET = "ab'sZ9é à \u0085 　\n\t  .,!ÿžЖ漢😀<|endoftext|>\x1c"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(exclude_categories=["Cs"])))), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(whole, texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_files, "PIECE", 16)
        assert streamed(texts) == [whole(x) for x in texts]


def test_long_texts_are_cut(whole):
    rng = random.Random(3)
    long = " ".join(rng.choice(["ba", "don't", "x1", "é", "\n", "", "漢字"]) for _ in range(300_000))
    assert streamed([None, long, "", "a" * 70_000]) == [whole(x) for x in ("", long, "", "a" * 70_000)]


def test_pieces_cover_texts():
    at = np.array([0, 0, 5, 40, 40, 41])
    parts = list(runs.pieces(at, lambda low, high: np.array([x for x in (11, 19, 33) if low < x < high]), 10))
    assert parts == [(0, 5), (5, 11), (11, 19), (19, 33), (33, 41)]


@pytest.mark.parametrize("shard_bytes", [1 << 30, 4_000])
def test_files_read_back(spark, documents, corpus, whole, shard_bytes):
    folder = new_folder(spark, "token-files")
    shards = token_files.write_tokens(documents(corpus).repartition(3), folder, vocabulary(), END, shard_bytes)
    rows = token_files.read_documents(shards, with_tokens=True).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    expected = sorted(((k, tuple(whole(text))) for k, text, *_ in corpus), key=str)
    assert sorted(((r["doc_id"], tuple(r["tokens"])) for r in rows), key=str) == expected
    start = 0
    for r in rows:
        assert (r["start"], r["n_tokens"]) == (start, len(r["tokens"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["tokens"], "<u4").tobytes())
        start += r["n_tokens"]

    local = token_files.TokenFiles(folder)
    assert len(local) == len(rows) and local.document(0).dtype == np.dtype("<u2")
    assert [local.document(k).tolist() for k in range(len(rows))] == [r["tokens"] for r in rows]
    every = [x for r in rows for x in r["tokens"]]
    for at in (0, len(every) // 3, len(every) - 5, len(every)):
        assert local.window(at, 2_000).tolist() == every[at : at + 2_000]
    bases = [r["base"] for r in shards.orderBy("shard").collect()]
    assert bases == sorted(bases) and bases[0] == 0


def test_one_id_spreads_over_shards(spark, documents):
    rows = [(7, "the same text")] * 900 + [(k, f"text {k}") for k in range(100)]
    folder = new_folder(spark, "token-files")
    shards = token_files.write_tokens(documents(rows), folder, vocabulary(), END, 1_000)
    assert shards.agg(F.max("n_documents")).first()[0] < 300
    assert token_files.read_documents(shards).count() == 1_000


def test_files_of_other_attempts_are_not_read(spark, documents, whole):
    folder = new_folder(spark, "token-files")
    shards = token_files.write_tokens(documents([(1, "a b"), (2, "c")]), folder, vocabulary(), END)
    name = shards.first()["tokens"].removeprefix("file:")
    stray = name.rsplit("-", 1)[0] + "-999999.tokens"
    with open(stray, "wb") as file:
        file.write(b"\1\2\3")
    again = token_files.read_documents(token_files.read_shards(spark, folder), with_tokens=True).orderBy("start").collect()
    assert [r["tokens"] for r in again] == [whole("a b"), whole("c")]


def test_empty_table_and_wide_ids(spark, documents):
    folder = new_folder(spark, "token-files")
    assert token_files.read_documents(token_files.write_tokens(documents([]), folder, vocabulary(), END)).collect() == []
    assert len(token_files.TokenFiles(folder)) == 0 and token_files.TokenFiles(folder).window(0, 5).tolist() == []
    folder = new_folder(spark, "token-files")
    token_files.write_tokens(documents([(1, "a")]), folder, vocabulary(), 70_000)
    assert token_files.TokenFiles(folder).document(0).tolist()[-1] == 70_000


def test_other_vocabularies_are_not_cut(spark, documents):
    name = "word_bpe_49k.json"
    tokenizer = token_files.encoder(vocabulary(name), END)
    assert not tokenizer.cuttable and json.loads(vocabulary(name))["model"]["type"] == "BPE"
    texts = ["One  two THREE", "", "x" * 300, " a b "]
    folder = new_folder(spark, "token-files")
    shards = token_files.write_tokens(documents(list(enumerate(texts))), folder, vocabulary(name), END)
    rows = token_files.read_documents(shards, with_tokens=True).orderBy("start").collect()
    plain = [[*tokenizer.tokenizer.encode(x, add_special_tokens=False).ids, END] for x in texts]
    assert [r["tokens"] for r in rows] == plain
