"""Language-model scoring with a probabilistic suffix tree over words.

A text is its words (A-Z lower-cased) and one end. The tree's contexts are the
word sequences that occur LEAST times in the training texts, whatever their
number, found level by level: a sequence is only counted where the sequences it
extends may have passed.

A context lists the next words seen often enough after it, with discounted
relative frequencies; the rest of its probability goes to all other words in
proportion to the next shorter context (its suffix), down to the root, the
additively smoothed word frequencies. A context is retained when its counts
diverge from its suffix's prediction by more than DIVERGENCE nats for every
number it needs. A word is scored in the longest retained suffix of what stands
before it. All probabilities after a context add up to 1.

A score is a sum over the sequences that end at each token. A retained context
gives the log of its rest; a word listed in it gives what it has above that rest
and the shorter context's prediction. So the tree is a table of sequences and
gains, and no task needs all of it: occurrences meet the table in buckets of
bounded size, and only sums return to the documents. The HEAD most frequent
sequences of each length are broadcast to keep their occurrences at home.

Contexts have up to DEPTH words, fewer if no longer sequence occurs LEAST times.

A sequence is known by a 64-bit number, made of those of its prefix and its
suffix. Null and empty texts are one end. A null id counts as held out. Without
training texts every token has count 0. Repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import ROW_KEY, keyed, released, written
from tradewind.llm.words import BASE, WHITESPACE, byte_values, mixed, slices, words

#: Least count of a context and of a listed continuation.
LEAST = 4
#: Sequences of each length that are broadcast, at most: 16 bytes each.
HEAD = 1 << 18
#: Steps by which frequencies are told apart to find them, for each doubling.
FINENESS = 16
#: Words of the longest context.
DEPTH = 5
#: Nats by which a context must improve on its suffix, for each continuation it lists.
DIVERGENCE = 2.0
DISCOUNT = 0.5
ADDED = 0.1
#: Tokens worked on at a time, and entries of a bucket.
SLICE = 1 << 21
#: Tokens whose longer sequences are worked on at a time.
PIECE = 1 << 18
#: Occurrences counted in a task before they are sent.
HELD = 1 << 20
BUCKET = 4_000_000
#: Bits for each sequence in the filter of those that may be there, and the most bits it has: beyond, more pass it.
FILTER_SHARE, FILTER_MOST = 16, 1 << 28
BITS = 1 << 15

#: Numbers of the two marks; words are 64-bit mixtures.
START, END = np.uint64(1), np.uint64(2)
VALUES = byte_values(WHITESPACE)


def marked(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, each between START and END, and where each text begins."""
    first = np.cumsum(counts) - counts + 2 * np.arange(len(counts))
    tokens = np.empty(len(numbers) + 2 * len(counts), np.uint64)
    inner = np.arange(len(numbers)) + 1 + 2 * np.repeat(np.arange(len(counts)), counts)
    tokens[first], tokens[first + counts + 1], tokens[inner] = START, END, numbers
    return tokens, first


def token_slices(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    numbers, counts = words(batch.column("text"), VALUES)
    ends = np.r_[0, np.cumsum(counts)]
    for low, high in slices(counts, most):
        yield low, high, *marked(numbers[ends[low] : ends[high]], counts[low:high])


def find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in a sorted table, -1 for what it lacks. Sorted numbers are found faster, as neighbours are in the cache."""
    if not len(table):
        return np.full(len(wanted), -1, np.int64)
    order = np.argsort(wanted)
    place = np.empty(len(wanted), np.int64)
    place[order] = np.searchsorted(table, wanted[order])
    place[place == len(table)] = 0
    return np.where(table[place] == wanted, place, -1)


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers in order, a place of each, and how often each occurs; a plain sort is faster than a stable one."""
    order = np.argsort(key)
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(key)])
    return ordered[first], order[first], np.diff(np.r_[first, len(key)])


def extended(prefix: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """The numbers of the sequences of ``length`` words with these beginnings and ends."""
    return mixed(prefix * BASE + suffix + np.uint64(length))


def longer(numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """From the numbers of the sequences one word shorter that end at each token: those that begin, and the sequences."""
    prefix = np.r_[np.uint64(0), numbers[:-1]]
    return prefix, extended(prefix, numbers, length)


def places_in_texts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.arange(len(tokens)) - np.repeat(first, np.diff(np.r_[first, len(tokens)]))


def filter_bits(keys: DataFrame) -> np.ndarray:
    """A bit map of the low bits of ``key``, 8 bits a byte: sized by the number of rows, up to 32 MB."""
    size = BITS
    rows = keys.count()
    while size < min(FILTER_SHARE * rows, FILTER_MOST):
        size *= 2
    place = F.pmod("key", F.lit(size))
    found = (
        keys.select((place / BITS).cast("int").alias("part"), (place % BITS).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(size // 8, np.uint8)
    for part, blob in found:
        bits[part * BITS // 8 : (part + 1) * BITS // 8] = np.frombuffer(blob, np.uint8)
    return bits


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bucket_of(key: str, buckets: int) -> Column:
    """The key as an unsigned number modulo ``buckets``, as numpy has it."""
    high, low = F.shiftrightunsigned(key, 32), F.col(key).bitwiseAND(0xFFFFFFFF)
    return F.pmod(high % buckets * (2**32 % buckets) + low % buckets, F.lit(buckets)).cast("int")


def word_counts(training: DataFrame) -> DataFrame:
    """(token, n) of every distinct training token, START among them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list) -> pa.RecordBatch:
            token, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            n = np.bincount(place, np.concatenate([x for _, x in parts])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

        held = []
        for batch in batches:
            for _, _, tokens, _ in token_slices(batch):
                held.append(np.unique(tokens, return_counts=True))
                if sum(len(x) for x, _ in held) > SLICE:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    counts = training.select("text").mapInArrow(counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return written(counts, "word-counts")


def sequences(training: DataFrame, shorter: DataFrame, length: int, buckets: int) -> DataFrame:
    """(key, context, suffix, n) of the sequences of ``length`` words that occur at least LEAST times.

    ``shorter``: those one word shorter (key). Occurrences travel as packed blocks, each to the bucket of its number."""
    bits = filter_bits(shorter)
    buckets = 4 * buckets  # an entry is 20 bytes

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list) -> pa.RecordBatch:
            context, suffix = (np.concatenate(x) for x in zip(*held, strict=True))
            key, place, n = distinct(extended(context, suffix, length))
            bucket, context, suffix = (key % np.uint64(buckets)).astype(np.int64), context[place], suffix[place]
            order = np.argsort(context)  # equal contexts in a row pack well
            order = order[np.argsort(bucket[order].astype(np.min_scalar_type(buckets)), kind="stable")]
            bucket, context, suffix, n = bucket[order], context[order], suffix[order], n[order].astype("<u4")
            cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
            blobs = [[x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for x in (context, suffix, n)]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]].astype(np.int32)), *(pa.array(x, pa.binary()) for x in blobs)],
                ["bucket", "contexts", "suffixes", "counts"],
            )

        held = []
        for batch in batches:
            for _, _, tokens, first in token_slices(batch, PIECE):
                at, numbers = places_in_texts(tokens, first), tokens
                for k in range(2, length):
                    numbers = longer(numbers, k)[1]
                passed = may_hold(bits, numbers)
                use = (at >= length - 1) & passed & np.r_[False, passed[:-1]]
                if use.any():
                    held.append((np.r_[np.uint64(0), numbers[:-1]][use], numbers[use]))
                if sum(len(x) for x, _ in held) > HELD:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    def summed(rows: pa.Table) -> pa.Table:
        context, suffix, n = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)])
            for name, kind in (("contexts", np.uint64), ("suffixes", np.uint64), ("counts", "<u4"))
        )
        key = extended(context, suffix, length)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        total = np.add.reduceat(n[order].astype(np.int64), first)
        first, total = first[total >= LEAST], total[total >= LEAST]
        place = order[first]
        numbers = (key[first], context[place], suffix[place])
        return pa.table([*(pa.array(x.view(np.int64)) for x in numbers), pa.array(total)], names=["key", "context", "suffix", "n"])

    blocks = training.select("text").mapInArrow(packed, "bucket int, contexts binary, suffixes binary, counts binary")
    found = blocks.groupBy("bucket").applyInArrow(summed, "key long, context long, suffix long, n long")
    return written(found, f"sequences-{length}")


def continued(found: DataFrame, shorter: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The sequences of a length (key, n, log10 probability of the last word after the others, gain), and the retained
    contexts (context, rest).

    ``shorter``: the sequences one word shorter, alike. The suffix of a listed sequence is listed itself."""
    seen = shorter.select(F.col("key").alias("context"), F.col("n").alias("seen"))
    before = shorter.select(F.col("key").alias("suffix"), F.col("log_p").alias("shorter"))
    own = (F.col("n") - DISCOUNT) / F.col("seen")
    listed = written(
        found.join(seen, "context").join(before, "suffix").select("key", "context", "n", "seen", own.alias("own"), "shorter"),
        f"listed-{length}",
    )
    sums = listed.groupBy("context").agg(
        F.max("seen").alias("seen"),
        F.count("*").alias("listed"),
        (1 - F.sum("own")).alias("left"),
        (1 - F.sum(F.pow(F.lit(10.0), F.col("shorter")))).alias("left_shorter"),
        F.sum(F.col("own") * (F.log("own") - F.col("shorter") * math.log(10))).alias("gain"),
    )
    gain = F.col("gain") + F.col("left") * F.log(F.col("left") / F.col("left_shorter"))
    retained = (
        sums.where("left > 1e-12 and left_shorter > 1e-12")
        .where(F.col("seen") * gain >= DIVERGENCE * (F.col("listed") + 1))
        .select("context", F.log10(F.col("left") / F.col("left_shorter")).alias("rest"))
    )
    retained = written(retained, f"contexts-{length}")
    there = F.col("rest").isNotNull()
    longer = listed.join(retained, "context", "left").select(
        "key",
        "n",
        F.when(there, F.log10("own")).otherwise(F.col("shorter")).alias("log_p"),
        F.when(there, F.log10("own") - F.col("shorter") - F.col("rest")).otherwise(0.0).alias("gain"),
    )
    longer = written(longer, f"continuations-{length}")
    released(found, listed)
    return longer, retained


def tree(training: DataFrame, counts: DataFrame, total: int, distinct: int, depth: int, buckets: int) -> DataFrame:
    """(key, length, n, gain): the frequent words, and the longer sequences with a gain."""
    log_p = F.log10((F.col("n") + ADDED) / (total + ADDED * (distinct + 1)))
    level = counts.where(F.col("n") >= LEAST).select(F.col("token").alias("key"), "n", log_p.alias("log_p"), F.lit(0.0).alias("gain"))
    model, held = None, []
    for length in range(1, depth + 2):
        of = level.select("key", F.lit(length).alias("length"), "n", "gain")
        found = sequences(training, level, length + 1, buckets) if length <= depth else None
        last = found is None or found.isEmpty()
        if not last:
            level, retained = continued(found, level, length + 1)
            held += [level, retained]
            rest = retained.withColumnRenamed("context", "key")
            of = of.join(rest, "key", "left").select(
                "key", "length", "n", (F.col("gain") + F.coalesce("rest", F.lit(0.0))).alias("gain")
            )
        model = of if model is None else model.union(of)
        if last:
            break
    model = written(model.where("length = 1 or gain <> 0"), "suffix-tree")
    released(*held)
    return model


def head_counts(model: DataFrame, most: int) -> dict[int, int]:
    """For each length the least count of its ``most`` most frequent sequences, by a histogram of the counts."""
    step = F.floor(F.log2("n") * FINENESS).cast("int")
    steps = model.groupBy("length", step.alias("step")).agg(F.min("n").alias("n"), F.count("*").alias("rows")).collect()
    least = {}
    for length in {r["length"] for r in steps}:
        held, least[length] = 0, 1 << 62
        for r in sorted((r for r in steps if r["length"] == length), key=lambda r: -r["step"]):
            held += r["rows"]
            if held > most:
                break
            least[length] = r["n"]
    return least


def in_head(least: dict[int, int]) -> Column:
    frequent = (F.col("key") == int(START)) & (F.col("length") == 1)
    for length, n in least.items():
        frequent |= (F.col("length") == length) & (F.col("n") >= n)
    return frequent


class Head:
    """The most frequent sequences, length by length, and a filter of all longer than a word."""

    def __init__(self, model: DataFrame, least: dict[int, int], total: int, distinct: int) -> None:
        rows = model.where(in_head(least)).toArrow()  # HEAD rows of each length at most
        key, length, n, gain = (rows.column(x).to_numpy() for x in ("key", "length", "n", "gain"))
        key = key.view(np.uint64)
        order = np.argsort(key)
        places = [order[length[order] == k] for k in range(1, max(least, default=1) + 1)]
        self.keys, self.gains = [key[x] for x in places], [np.r_[gain[x], 0.0] for x in places]
        self.root = np.r_[np.log10((n[places[0]] + ADDED) / (total + ADDED * (distinct + 1))), 0.0]
        self.bits = filter_bits(model.where("length > 1"))

    def score(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token the root's part and the gain, as far as these sequences go; which words are not among them; and
        the longer sequences that are elsewhere, if anywhere: (token place, number)."""
        at, numbers = places_in_texts(tokens, first), tokens
        place = find(self.keys[0], tokens)
        root, gain, rare = self.root[place], self.gains[0][place], (at > 0) & (place < 0)
        ends, elsewhere = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for length in range(2, len(self.keys) + 1):
            numbers = longer(numbers, length)[1]
            end = np.flatnonzero((at >= length - 1) & may_hold(self.bits, numbers))
            place = find(self.keys[length - 1], numbers[end])
            gain[end] += self.gains[length - 1][place]
            ends.append(end[place < 0])
            elsewhere.append(numbers[end[place < 0]])
        return root, gain, rare, np.concatenate(ends), np.concatenate(elsewhere)


DOCUMENT = pa.struct(
    [("doc_id", pa.int64()), (ROW_KEY, pa.int64()), ("held_out", pa.bool_()), ("place", pa.int64()), ("n_tokens", pa.int64()),
     ("n_frequent", pa.int64()), ("root", pa.float64()), ("gain", pa.float64())]
)
SCORED = (
    "bucket int, words boolean, keys binary, counts binary, places binary, block long, "
    f"documents array<struct<doc_id:long, {ROW_KEY}:long, held_out:boolean, place:long, n_tokens:long, n_frequent:long, "
    "root:double, gain:double>>"
)


def frequent_scores(documents: DataFrame, head: Head, buckets: int) -> DataFrame:
    """For each slice of documents a row without a bucket, with their sums over the most frequent sequences; and rows for
    the buckets that their other words, and their other sequences, belong to: those of each document in turn."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low, high, tokens, first in token_slices(batch, PIECE):
                n = high - low
                owner = np.repeat(np.arange(n), np.diff(np.r_[first, len(tokens)]))
                root, gain, rare, end, number = head.score(tokens, first)
                predicted = np.ones(len(tokens), bool)
                predicted[first] = False
                columns = [
                    *(batch.column(x)[low:high] for x in ("doc_id", ROW_KEY, "held_out")),
                    pa.array(place + np.arange(n)),
                    pa.array(np.bincount(owner[predicted], minlength=n)),
                    pa.array(np.bincount(owner[predicted & ~rare], minlength=n)),
                    pa.array(np.bincount(owner[predicted], root[predicted], n)),
                    pa.array(np.bincount(owner, gain, n)),
                ]
                own = pa.ListArray.from_arrays([0, n], pa.StructArray.from_arrays(columns, fields=list(DOCUMENT)))
                none = [pa.nulls(1, x) for x in (pa.int32(), pa.bool_(), *[pa.binary()] * 3)]
                names = ["bucket", "words", "keys", "counts", "places", "block", "documents"]
                yield pa.RecordBatch.from_arrays([*none, pa.array([place], pa.int64()), own], names)

                for key, of, word in ((tokens[rare], owner[rare], True), (number, owner[end], False)):
                    bucket = (key % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket * n + of, kind="stable")
                    key, of, bucket = key[order], of[order], bucket[order]
                    cuts = np.r_[np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)]
                    out = []
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        who, many = np.unique(of[a:b], return_counts=True)
                        out.append((word, *(x.tobytes() for x in (key[a:b], many.astype("<u4"), place + who))))
                    if out:
                        kinds = pa.bool_(), *[pa.binary()] * 3
                        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                        rest = [pa.array([place] * len(out), pa.int64()), pa.nulls(len(out), pa.list_(DOCUMENT))]
                        yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]], pa.int32()), *columns, *rest], names)
                place += n

    return written(documents.mapInArrow(scored, SCORED), "frequent-scores")


def rare_scores(blocks: DataFrame, known: DataFrame, total: int, distinct: int, buckets: int) -> DataFrame:
    """(place, rare_root, rare_gain, n_rare): the sums over the sequences that are not broadcast, and how many words are known.

    ``known``: their (key, n, gain), n being 0 for more than a word."""

    def met(blocks: pa.Table, known: pa.Table) -> pa.Table:
        table = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(table)
        table = table[order]
        n, gain = (np.r_[known.column(x).to_numpy()[order], 0] for x in ("n", "gain"))
        out = []
        for k in range(len(blocks)):
            row = {x: blocks.column(x)[k].as_py() for x in ("words", "keys", "counts", "places", "block")}
            many = np.frombuffer(row["counts"], "<u4")
            owner = np.repeat(np.arange(len(many)), many)
            at = find(table, np.frombuffer(row["keys"], np.uint64))
            root, found = np.zeros(len(many)), np.zeros(len(many), "<u4")
            if row["words"]:
                count = n[at]
                root = np.bincount(owner, np.log10((count + ADDED) / (total + ADDED * (distinct + 1))), len(many))
                found = np.bincount(owner[count > 0], minlength=len(many)).astype("<u4")
            sums = root, np.bincount(owner, gain[at], len(many)), found
            out.append((row["block"], row["places"], *(x.tobytes() for x in sums)))
        kinds = pa.int64(), *[pa.binary()] * 4
        columns = zip(*out, strict=True) if out else [[]] * 5
        names = ["block", "places", "roots", "gains", "found"]
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=names)

    def summed(replies: pa.Table) -> pa.Table:
        """A block's documents have one sum from each bucket."""
        place, root, gain, found = (
            np.concatenate([np.frombuffer(x.as_py(), kind) for x in replies.column(name)])
            for name, kind in (("places", np.int64), ("roots", np.float64), ("gains", np.float64), ("found", "<u4"))
        )
        own, owner = np.unique(place, return_inverse=True)
        n_rare = np.bincount(owner, found).astype(np.int64)
        return pa.table(
            {"place": own, "rare_root": np.bincount(owner, root), "rare_gain": np.bincount(owner, gain), "n_rare": n_rare}
        )

    replies = (
        blocks.groupBy("bucket")
        .cogroup(known.withColumn("bucket", bucket_of("key", buckets)).groupBy("bucket"))
        .applyInArrow(met, "block long, places binary, roots binary, gains binary, found binary")
    )
    return replies.groupBy("block").applyInArrow(summed, "place long, rare_root double, rare_gain double, n_rare long")


def score_documents(documents: DataFrame, held_out, head: int = HEAD, depth: int = DEPTH) -> DataFrame:
    """Per document row: doc_id, row key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out``: a condition on the documents; its rows are scored, not learned
    from. Scores are log10 probabilities of the whole text. ``head`` decides what
    is broadcast, not what is learned."""
    flagged = keyed(documents).withColumn("held_out", F.coalesce(held_out, F.lit(True)))
    training = flagged.where(~F.col("held_out"))
    counts = word_counts(training)
    predicted = counts.where(F.col("token") != int(START))
    total, distinct = predicted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-total // BUCKET))

    model = tree(training, counts, total, distinct, depth, buckets)
    least = head_counts(model, head)
    scored = frequent_scores(flagged, Head(model, least, total, distinct), buckets)
    seldom = predicted.where(F.col("n") < LEAST).select(F.col("token").alias("key"), "n", F.lit(0.0).alias("gain"))
    n = F.when(F.col("length") == 1, F.col("n")).otherwise(0)
    known = model.where(~in_head(least)).select("key", n.alias("n"), "gain").union(seldom)
    rare = rare_scores(scored.where("bucket IS NOT NULL").drop("documents"), known, total, distinct, buckets)
    base = F.col("root") + F.coalesce("rare_root", F.lit(0.0))
    return scored.where("bucket IS NULL").select(F.inline("documents")).join(rare, "place", "left").select(
        "doc_id",
        ROW_KEY,
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain") + F.coalesce("rare_gain", F.lit(0.0))).alias("score"),
    )
