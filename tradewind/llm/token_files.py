"""Token ids of a corpus in flat files that training code maps into memory.

A folder holds, for each shard,

    <shard>-<attempt>.tokens      unsigned 16-bit ids where the vocabulary allows, else 32-bit, little-endian
    <shard>-<attempt>.offsets     unsigned 64-bit places in the shard where documents begin, and its end
    <shard>-<attempt>.documents   signed 64-bit ids of the documents, nulls (which come first) as 0

and the Parquet table ``shards``, a row for each shard with its files, its sizes
and its base: the token ids in all shards before it, a prefix sum. A document's
global place is its shard's base plus its offset.

Shards are ranges of ascending document ids, so one key with any number of rows
spreads over shards: repeated ids stand by a hash of their texts, repeated rows in
any order. A task writes the files of its shard under the name of its attempt and
hands in one row; only rows of attempts that Spark accepted are in ``shards``, so
files of lost or repeated tasks are never read.

Texts are encoded by the tokenizers library. A byte-level vocabulary with the usual
pattern cuts a text before every single space between two visible characters,
whatever else stands around it. So such texts are cut there, distinct pieces are
encoded once, many in one text, and told apart again by the bytes of their tokens;
ids are then put together for every text, and a very long text is never held as
encodings. With any other vocabulary whole texts are encoded.

Null and empty texts are one end id. An empty table gives no shard. Strings of
special tokens inside a text are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.runs import PIECE, binary, dictionary, pieces
from tradewind.llm.words import text_buffers

#: Bytes of text that a shard holds, about.
SHARD_BYTES = 32 << 20
#: Whole texts of other vocabularies encoded at a time, in bytes.
BATCH_BYTES = 1 << 20
#: Distinct pieces whose ids a worker remembers, some 110 MB.
KNOWN = 600_000
#: Token ids read at a time.
READ_TOKENS = 1 << 20

SHARD = (
    "shard int, tokens string, offsets string, documents string, kind string, n_documents long, n_null long, n_tokens long"
)

# Bytes by their part in a cut: visible ASCII characters, and the first bytes of U+00C0 to U+07FF, which hold no white space.
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True
TWO_BYTES = np.zeros(256, bool)
TWO_BYTES[0xC3:0xE0] = True


def cuts(part: np.ndarray) -> np.ndarray:
    """Which bytes are single spaces between two visible characters: a piece of the pattern begins at each."""
    before = VISIBLE[part]
    before[1:] |= TWO_BYTES[part[:-1]] & (part[1:] >= 0x80)
    here = part == 0x20
    here[:1] = False
    here[-1:] = False
    here[1:-1] &= before[:-2] & (VISIBLE[part[2:]] | TWO_BYTES[part[2:]])
    return here


class Encoder:
    """A vocabulary, what its ids are stored as, and whether texts may be cut at spaces."""

    def __init__(self, tokenizer, end_id: int, cuttable: bool) -> None:
        self.tokenizer, self.end_id, self.cuttable = tokenizer, end_id, cuttable
        vocabulary = tokenizer.get_vocab()
        largest = max(end_id, *vocabulary.values())
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        # Byte-level tokens are written with one character for each byte.
        self.bytes = np.zeros(largest + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.length, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.dtype)

    def encoded(self, pieces: list[bytes], joined: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has). The first ``joined`` may stand behind one another in one text."""
        texts = [b"".join(pieces[:joined]), *pieces[joined:]]
        found = [x.ids for x in self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]
        one = np.array(found[0], np.int64)
        ends = np.cumsum(np.fromiter(map(len, pieces[:joined]), np.int64, joined))
        until = np.r_[0, np.searchsorted(np.cumsum(self.bytes[one]), ends) + 1] if joined else np.zeros(1, np.int64)
        rest = [np.array(x, np.int64) for x in found[1:]]
        length = np.r_[np.diff(until), np.fromiter(map(len, rest), np.int64, len(rest))]
        return np.concatenate([one, *rest]).astype(self.dtype), length

    def places(self, distinct: list[bytes], joinable: np.ndarray) -> np.ndarray:
        """Where the ids of distinct pieces are among those known, the new ones being encoded."""
        if len(self.known) > KNOWN or not self.cuttable:
            self.forget()
        new = np.array([k for k, x in enumerate(distinct) if x not in self.known], np.int64)
        if len(new):
            fit = joinable[new]
            pieces = [distinct[k] for k in np.r_[new[fit], new[~fit]].tolist()]
            ids, length = self.encoded(pieces, int(fit.sum()))
            self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.first = np.r_[self.first, len(self.ids) + np.cumsum(length) - length]
            self.length, self.ids = np.r_[self.length, length], np.r_[self.ids, ids]
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))

    def stream(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The texts in parts: (ids with the end id of each text that ends there, places right behind the end ids)."""
        data, at = text_buffers(texts)
        ended = 0

        def places(low: int, high: int) -> np.ndarray:
            return np.flatnonzero(cuts(data[low:high])) + low if self.cuttable else np.empty(0, np.int64)

        for low, high in pieces(at, places, PIECE if self.cuttable else BATCH_BYTES):
            cut = cuts(data[low:high]) if self.cuttable else np.zeros(high - low, bool)
            begins = cut.copy()
            begins[np.r_[low, at[(at > low) & (at < high)]] - low] = True
            starts = np.flatnonzero(begins)
            code, distinct = dictionary(binary(data[low:high], np.r_[starts, high - low]))
            inner = cut[starts] & np.r_[cut[starts[1:]], False]
            joinable = np.zeros(len(distinct), bool)
            joinable[code[inner]] = True
            known = self.places(distinct.to_pylist(), joinable)[code]
            size = self.length[known]
            total = np.cumsum(size)
            place = np.repeat(self.first[known] - (total - size), size) + np.arange(int(size.sum()))
            # Texts that end here, empty ones included, get their end id behind their last piece.
            until = int(np.searchsorted(at[1:], high, "right"))
            behind = np.r_[0, total][np.searchsorted(starts, at[ended + 1 : until + 1] - low)]
            yield (
                np.insert(self.ids[place], behind, self.dtype.type(self.end_id)),
                behind + np.arange(1, until - ended + 1),
            )
            ended = until
        left = len(texts) - ended
        if left:
            yield np.full(left, self.end_id, self.dtype), np.arange(1, left + 1)


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str, end_id: int) -> Encoder:
    """From the text of a file of the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    said = json.loads(vocabulary)
    before = said.get("pre_tokenizer") or {}
    cuttable = (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and said.get("normalizer") is None
        and all(x["special"] for x in said.get("added_tokens", []))
    )
    return Encoder(tokenizer, end_id, cuttable)


def mapped(path: str, kind: str) -> np.ndarray:
    """A flat file as an array: mapped into memory where it lies in a file system of the machine, else read."""
    system, place = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.frombuffer(pa.memory_map(place).read_buffer(), kind)
    with system.open_input_file(place) as file:
        return np.frombuffer(file.read(), kind)


def write_tokens(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Encode the texts into ``folder``, a new one that all executors reach; the table of shards.

    ``vocabulary``: the text of a tokenizer file, some megabytes, sent to every executor."""
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    sent = spark.sparkContext.broadcast(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, place = fs.FileSystem.from_uri(folder)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        files, documents, nulls, written = None, 0, 0, 0
        for batch in batches:
            if not len(batch):
                continue
            if files is None:
                system.create_dir(place)
                files = [system.open_output_stream(f"{place}/{name}.{x}") for x in ("tokens", "offsets", "documents")]
                files[1].write(np.zeros(1, "<u8").tobytes())
                encoding = encoder(sent.value, end_id)
            ids = batch.column("doc_id")
            files[2].write(ids.fill_null(0).to_numpy().astype("<i8").tobytes())
            documents, nulls = documents + len(ids), nulls + ids.null_count
            for tokens, ends in encoding.stream(batch.column("text")):
                files[0].write(tokens.tobytes())
                files[1].write((written + ends).astype("<u8").tobytes())
                written += len(tokens)
        if files is not None:
            for file in files:
                file.close()
            names = (f"{folder}/{name}.{x}" for x in ("tokens", "offsets", "documents"))
            row = (task.partitionId(), *names, encoding.dtype.str, documents, nulls, written)
            kinds = [pa.int32(), *[pa.string()] * 4, *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], [x.split()[0] for x in SHARD.split(", ")]
            )

    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        # The row's number only spreads repeated rows.
        .repartitionByRange(shards, *order, F.monotonically_increasing_id())
        .sortWithinPartitions(*order)
    )
    # One row per shard from here on.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    path = f"{folder}/shards"
    ordered.mapInArrow(write, SHARD).write.parquet(f"{path}-sizes")
    sizes = spark.read.schema(SHARD).parquet(f"{path}-sizes")
    sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(path)
    return read_shards(spark, folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SHARD}, base long").parquet(f"{folder}/shards")


def read_documents(shards: DataFrame, with_tokens: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start (its global place), n_tokens, ids_crc32 (of its ids as 32-bit
    little-endian integers), and on request the ids themselves (tokens)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                tokens = mapped(shard["tokens"], shard["kind"])
                offsets = mapped(shard["offsets"], "<u8").astype(np.int64)
                ids = mapped(shard["documents"], "<i8")
                # Some documents at a time, or one long one.
                borders = np.unique(np.r_[0, np.searchsorted(offsets, np.arange(0, offsets[-1], READ_TOKENS)), len(ids)])
                for low, high in zip(borders[:-1], borders[1:], strict=True):
                    wide = tokens[offsets[low] : offsets[high]].astype("<u4")
                    at = offsets[low : high + 1] - offsets[low]
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    columns = [
                        pa.array(ids[low:high], pa.int64(), mask=np.arange(low, high) < shard["n_null"]),
                        pa.array(shard["base"] + offsets[low:high]),
                        pa.array(np.diff(at)),
                        pa.array(crc, pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_tokens:
                        columns.append(pa.ListArray.from_arrays(at.astype(np.int32), pa.array(wide.astype(np.int64))))
                        names.append("tokens")
                    yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", tokens array<bigint>" if with_tokens else "")
    number = max(1, shards.count())
    return shards.repartitionByRange(number, "shard").mapInArrow(read, kinds)


class TokenFiles:
    """The files of a folder as one long array of ids, for training code on one machine: nothing is read before its use."""

    def __init__(self, folder: str) -> None:
        system, place = fs.FileSystem.from_uri(folder)
        self.shards = sorted(pq.read_table(f"{place}/shards", filesystem=system).to_pylist(), key=lambda x: x["shard"])
        self.bases = np.array([x["base"] for x in self.shards] + [sum(x["n_tokens"] for x in self.shards)])
        self.firsts = np.cumsum([0] + [x["n_documents"] for x in self.shards])
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        """Documents."""
        return int(self.firsts[-1])

    def _shard(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self._open:
            self._open[k] = mapped(self.shards[k]["tokens"], self.shards[k]["kind"]), mapped(self.shards[k]["offsets"], "<u8")
        return self._open[k]

    def document(self, number: int) -> np.ndarray:
        """The ids of a document by its place in the order."""
        k = int(np.searchsorted(self.firsts, number, "right")) - 1
        tokens, offsets = self._shard(k)
        low, high = offsets[number - self.firsts[k] : number - self.firsts[k] + 2].astype(np.int64)
        return tokens[low:high]

    def window(self, start: int, length: int) -> np.ndarray:
        """Ids from a global place on, over documents and shards; fewer at the end."""
        found = []
        while length > 0 and start < self.bases[-1]:
            k = int(np.searchsorted(self.bases, start, "right")) - 1
            part = self._shard(k)[0][start - self.bases[k] :][:length]
            found.append(part)
            start, length = start + len(part), length - len(part)
        return np.concatenate(found) if found else np.empty(0, "<u2")

