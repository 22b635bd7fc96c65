"""Exact n-gram Jaccard join by vertical partitioning.

The n-grams of the corpus have one global order (that of their 64-bit numbers),
and every document's set is cut into fragments along it. Overlaps are counted
per fragment and summed per pair of documents.

1. The head fragment, counted for all documents. A document of n n-grams can
   lack at most n - ceil(t n) of a partner's, so of the first
   n - ceil(t n) + l n-grams at least l are in the partner's head as well.
   Documents with fewer shared n-grams in their head have no partner. The rest
   keep the rarest shared ones, as many as are needed for two partners to have
   one in common (prefix filter), and those that have one in common,
   directly or over others, are a cluster of candidates.
2. All fragments, counted for the documents of a cluster only. Clusters are cut
   into blocks of bounded size by set size; each pair of blocks whose sizes can
   agree is one matrix of partial counts per fragment, and the matrices of the
   fragments are added up. No pair is a row.

Equal sets are one class, so copies meet once. The result is the connected
components of the links, found over a spanning forest of each block pair, and
the number of links each class has. Null and empty texts have an empty set and
no link.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.shared import ROW_KEY, keyed, row_key, without_rows, written
from tradewind.llm.words import BASE, WHITESPACE, byte_values, mixed, slices, words

#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 85
SIZE = 4
#: Fragments of the global order, besides the head.
FRAGMENTS = 4
#: Sets, and n-grams, of a block of a cluster.
BLOCK_SETS = 256
BLOCK_GRAMS = 500_000
#: N-grams of a bucket of the head fragment, and of a bin of block pairs.
BUCKET_GRAMS = 2_000_000
#: Block pairs of a bin; the matrices of one take up to 1 MB.
BUCKET_UNITS = 64
#: Bits of the filter that tells which documents to read again; its size does not grow with the corpus.
FILTER_BITS = 1 << 23
BITS = 1 << 15
#: Columns of a matrix of counts worked on at a time.
COLUMNS = 4096

VALUES = byte_values(WHITESPACE)


def gram_sets(batch_words: np.ndarray, counts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-grams of each text."""
    n = len(batch_words)
    run = batch_words.copy()
    for k in range(1, min(size, n)):
        run[: n - k] = mixed(run[: n - k] * BASE + batch_words[k:])
    run = mixed(run)
    low = 0
    for count in counts:
        high = low + count
        if count >= size:
            grams = np.sort(run[low : high - size + 1])
            yield grams[np.r_[True, grams[1:] != grams[:-1]]]
        elif count:
            whole = hashlib.blake2b(batch_words[low:high].tobytes(), digest_size=8).digest()
            yield np.frombuffer(whole, np.uint64)
        else:
            yield batch_words[:0]
        low = high


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def head_surplus(n, percent: int):
    """l: how many n-grams the heads of partners share at least, for the smaller of them."""
    return np.maximum(1, (100 - percent) * n // 100)


def set_number(grams: np.ndarray) -> int:
    return int(np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), np.int64)[0])


def document_sets(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document row: doc_id, row key, n n-grams, head n-grams, and the number of its set (null if empty)."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(gram_sets(*words(batch.column("text"), VALUES), size))
            n = np.array([len(x) for x in sets], np.int64)
            head = np.minimum(n, n - least_overlap(n, percent) + head_surplus(n, percent))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column(ROW_KEY),
                    pa.array(n),
                    pa.array(head),
                    pa.array([set_number(x) if len(x) else None for x in sets], pa.int64()),
                ],
                ["doc_id", ROW_KEY, "n", "head", "set"],
            )

    return written(
        keyed(documents).mapInArrow(sized, f"doc_id long, {ROW_KEY} long, n long, head long, set long"), "gram-sets"
    )


def shared_heads(documents: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """(set, n, gram, frequency) for the head n-grams that more than one set has in its head.

    N-grams travel as packed blocks, each to the bucket of its number."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, counts = words(batch.column("text"), VALUES)
            ends = np.r_[0, np.cumsum(counts)]
            for low, high in slices(counts, 1 << 22):
                heads, sets, sizes, seen = [], [], [], set()
                for grams in gram_sets(numbers[ends[low] : ends[high]], counts[low:high], size):
                    n = len(grams)
                    number = set_number(grams) if n else 0
                    if n and number not in seen:
                        seen.add(number)
                        heads.append(grams[: n - least_overlap(n, percent) + head_surplus(n, percent)])
                        sets.append(number)
                        sizes.append(n)
                if not heads:
                    continue
                grams = np.concatenate(heads)
                owner = np.repeat(np.arange(len(heads)), [len(x) for x in heads])
                bucket = (grams % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                grams, owner, bucket = grams[order], owner[order], bucket[order]
                cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
                sets, sizes = np.array(sets, np.int64), np.array(sizes, np.int64)
                out = []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own, place = np.unique(owner[a:b], return_inverse=True)
                    blobs = grams[a:b], place.astype("<u4" if len(own) >> 16 else "<u2"), sets[own], sizes[own].astype("<u4")
                    out.append((int(bucket[a]), *(x.tobytes() for x in blobs)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)],
                    ["bucket", "grams", "owners", "sets", "sizes"],
                )

    def counted(rows: pa.Table) -> pa.Table:
        grams, sets, sizes = [], [], []
        for row in rows.to_pylist():
            own = np.frombuffer(row["sets"], np.int64)
            owner = np.frombuffer(row["owners"], "<u4" if len(own) >> 16 else "<u2")
            grams.append(np.frombuffer(row["grams"], np.int64))
            sets.append(own[owner])
            sizes.append(np.frombuffer(row["sizes"], "<u4")[owner])
        gram, own, n = np.concatenate(grams), np.concatenate(sets), np.concatenate(sizes)
        order = np.lexsort((own, gram))
        gram, own, n = gram[order], own[order], n[order]
        new = np.r_[True, (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])]
        gram, own, n = gram[new], own[new], n[new]
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        frequency = np.diff(np.r_[first, len(gram)])
        frequency = np.repeat(frequency, frequency)
        keep = frequency > 1
        return pa.table(
            {"set": own[keep], "n": n[keep].astype(np.int64), "gram": gram[keep], "frequency": frequency[keep]}
        )

    blocks = keyed(documents).mapInArrow(packed, "bucket int, grams binary, owners binary, sets binary, sizes binary")
    return blocks.groupBy("bucket").applyInArrow(counted, "set long, n long, gram long, frequency long")


def candidate_clusters(heads: DataFrame, percent: int) -> DataFrame:
    """(vertex: set, component: cluster) for the sets that have a candidate partner."""
    least = F.expr(f"(({percent} * n + 99) div 100)")
    surplus = F.greatest(F.lit(1), F.expr(f"{100 - percent} * (({percent} * n + 99) div 100) div 100")).cast("int")
    grams = F.array_sort(F.collect_list(F.struct("frequency", "gram")))
    rarest = (
        heads.groupBy("set", "n")
        .agg(grams.alias("grams"))
        .withColumn("least", least)
        .withColumn("surplus", surplus)
        .where(F.size("grams") >= F.col("surplus"))
        .select("set", F.explode(F.slice("grams", F.lit(1), F.size("grams") - F.col("surplus") + 1)).alias("of"))
        .select("set", F.col("of.gram").alias("gram"))
    )
    postings = written(rarest, "postings")
    hubs = postings.groupBy("gram").agg(F.min("set").alias("hub"), F.count("*").alias("df")).where("df > 1")
    return components(postings.join(hubs, "gram").select(F.col("set").alias("a"), F.col("hub").alias("b")))


def filter_bits(keys: DataFrame) -> np.ndarray:
    """A bit map of the low bits of ``key``: 1 MB, whatever the number of rows."""
    place = F.pmod("key", F.lit(FILTER_BITS))
    found = (
        keys.select((place / BITS).cast("int").alias("part"), (place % BITS).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS, bool)
    for part, blob in found:
        bits[part * BITS : (part + 1) * BITS] = np.unpackbits(np.frombuffer(blob, np.uint8), bitorder="little")
    return bits


def set_fragments(documents: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(row key, fragment, grams) of the documents in ``keys`` (key), and of a few others."""
    bits = filter_bits(keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = (np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(32)) // np.uint64(FRAGMENTS) << np.uint64(32)
        for batch in batches:
            key = batch.column(ROW_KEY).to_numpy()
            batch = batch.filter(pa.array(bits[key & (FILTER_BITS - 1)]))
            if not batch.num_rows:
                continue
            rows = []
            for grams in gram_sets(*words(batch.column("text"), VALUES), size):
                rows += [x.tobytes() for x in np.split(grams, np.searchsorted(grams, borders))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(ROW_KEY).to_numpy(), FRAGMENTS)),
                    pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), batch.num_rows)),
                    pa.array(rows, pa.binary()),
                ],
                [ROW_KEY, "fragment", "grams"],
            )

    return keyed(documents).mapInArrow(cut, f"{ROW_KEY} long, fragment int, grams binary")


def overlap_counts(grams: list[np.ndarray], left: int) -> np.ndarray:
    """How many n-grams each of the first ``left`` sets has in common with each of the rest, or with each other."""
    owner = np.repeat(np.arange(len(grams)), [len(x) for x in grams])
    number, place, n = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    order = order[n[place[order]] > 1]
    place, owner = place[order], owner[order]
    column = np.cumsum(np.r_[True, place[1:] != place[:-1]]) - 1 if len(place) else place
    rest = len(grams) - left
    total = np.zeros((left, rest or left), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        has = np.zeros((len(grams), column[b - 1] - low + 1), np.float32)
        has[owner[a:b], column[a:b] - low] = 1
        total += has[:left] @ (has[left:] if rest else has).T
    return total.astype("<u4")


def rows_by(table: pa.Table, name: str, *then: str) -> Iterator[pa.Table]:
    """The rows of each value of a column, in the order of the others."""
    table = table.sort_by([(x, "ascending") for x in (name, *then)])
    value = table.column(name).to_numpy()
    cuts = np.r_[np.flatnonzero(np.r_[True, value[1:] != value[:-1]]), len(table)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield table.slice(a, b - a)


PARTIAL = "bin int, unit long, left int, sets binary, sizes binary, counts binary"


def partial_counts(rows: pa.Table) -> pa.Table:
    """One fragment of a bin's block pairs: a matrix of overlaps for each pair."""
    out = []
    for unit in rows_by(rows, "unit", "side", "set"):
        left = int((unit.column("side").to_numpy() == 0).sum())
        counts = overlap_counts([np.frombuffer(x.as_py(), np.uint64) for x in unit.column("grams")], left)
        sets, sizes = unit.column("set").to_numpy(), unit.column("n").to_numpy()
        out.append(
            (unit.column("bin")[0].as_py(), unit.column("unit")[0].as_py(), left, sets.tobytes(), sizes.tobytes(), counts.tobytes())
        )
    kinds = pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
    names = "bin", "unit", "left", "sets", "sizes", "counts"
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def linked(percent: int):
    """Adds up the fragments' matrices of a bin's block pairs: (set, root within the pair of blocks, links)."""

    def summed(rows: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64),) * 3]
        for unit in rows_by(rows, "unit"):
            first = {k: unit.column(k)[0].as_py() for k in ("left", "sets", "sizes")}
            sets, n = np.frombuffer(first["sets"], np.int64), np.frombuffer(first["sizes"], np.int64)
            left = first["left"]
            alone = left == len(sets)
            a, b = slice(0, left), slice(0 if alone else left, None)
            common = sum(np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in unit.column("counts"))
            common = common.reshape(left, -1)
            link = 100 * common >= percent * (n[a, None] + n[None, b] - common)
            if alone:
                np.fill_diagonal(link, False)
            links = np.r_[link.sum(1), [] if alone else link.sum(0)].astype(np.int64)
            root = np.arange(len(sets))
            while True:  # each set takes the smallest root among its links, until nothing moves
                before = root.copy()
                far = np.where(link, root[b][None, :], len(sets)).min(1)
                root[a] = np.minimum(root[a], far)
                near = np.where(link, root[a][:, None], len(sets)).min(0)
                root[b] = np.minimum(root[b], near)
                root = root[root]
                if (root == before).all():
                    break
            some = links > 0
            found.append((sets[some], sets[root[some]], links[some]))
        return pa.table([np.concatenate(x) for x in zip(*found, strict=True)], names=["set", "root", "links"])

    return summed


def block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Members (cluster, set, n, row key) once for each pair of blocks that they belong to: unit, side added.

    A cluster that fits is one block. A larger one is cut into bands of set
    size, each as wide as the similarity allows, and a band into blocks by hash;
    blocks whose sizes are too far apart for any link don't meet. Blocks are
    counted by sums per cluster and band, so no task sees a whole cluster."""
    weight = F.greatest(F.lit(1 / BLOCK_SETS), F.col("n") / BLOCK_GRAMS)
    totals = members.groupBy("cluster").agg(F.sum(weight).alias("total"))
    width = math.log(100 / percent)
    band = F.when(F.col("total") <= 1, 0).otherwise(F.floor(F.log(F.col("n")) / width)).cast("long")
    banded = members.join(totals, "cluster").withColumn("band", band).drop("total")
    counts = banded.groupBy("cluster", "band").agg(F.ceil(F.sum(weight)).alias("blocks"))
    block = F.shiftleft("band", 32) + F.pmod(F.xxhash64("set"), F.col("blocks"))
    blocked = banded.join(counts, ["cluster", "band"]).withColumn("block", block).drop("band", "blocks")
    blocks = blocked.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    other = blocks.withColumnsRenamed({"block": "block_b", "least": "least_b", "most": "most_b"})
    near = F.expr(f"block <= block_b and 100 * most >= {percent} * least_b and 100 * most_b >= {percent} * least")
    pairs = blocks.join(other, "cluster").where(near).select("cluster", "block", "block_b")
    unit = F.xxhash64("cluster", "block", "block_b").alias("unit")
    roles = pairs.select(
        "cluster",
        unit,
        F.explode(
            F.when(F.col("block") == F.col("block_b"), F.array(_role("block", 0))).otherwise(
                F.array(_role("block", 0), _role("block_b", 1))
            )
        ).alias("role"),
    ).select("cluster", "unit", "role.block", "role.side")
    return blocked.join(roles, ["cluster", "block"]).drop("block")


def bin_count(paired: DataFrame) -> int:
    """Bins for these members of block pairs, a set counting once for each pair that it is in."""
    grams, units = paired.agg(F.coalesce(F.sum("n"), F.lit(0)), F.countDistinct("unit")).first()
    return max(1, -(-grams // BUCKET_GRAMS) * FRAGMENTS, -(-units // BUCKET_UNITS))


def _role(block: str, side: int) -> Column:
    return F.struct(F.col(block).alias("block"), F.lit(side).alias("side"))


def ngram_components(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per document row: doc_id, row key, n_shingles, component_id, n_links, keeper.

    ``component_id`` is the smallest doc_id (nulls last) reachable over links,
    ``n_links`` the number of other sets linked with the document's own, and
    ``keeper`` tells one row of each component, of those with that doc_id."""
    rows = document_sets(documents, size, percent)
    total = rows.agg(F.sum("head")).first()[0] or 0
    heads = shared_heads(documents, size, percent, max(1, -(-total // BUCKET_GRAMS)))
    clusters = candidate_clusters(heads, percent)

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW_KEY)).alias("first")
    classes = written(rows.where("n > 0").groupBy("set").agg(first, F.max("n").alias("n")), "gram-classes")
    members = classes.join(clusters, classes["set"] == clusters["vertex"]).select(
        F.col("component").alias("cluster"), "set", "n", F.col(f"first.{ROW_KEY}").alias(ROW_KEY)
    )
    members = written(members, "gram-clusters")
    paired = written(block_pairs(members, percent), "gram-block-pairs")
    bins = F.pmod("unit", F.lit(bin_count(paired))).cast("int").alias("bin")
    fragments = set_fragments(documents, members.select(F.col(ROW_KEY).alias("key")), size)
    # A row that repeats in the corpus comes once.
    fragments = fragments.join(members.select(ROW_KEY), ROW_KEY, "left_semi").dropDuplicates([ROW_KEY, "fragment"])
    parts = fragments.join(paired, ROW_KEY).select(bins, "unit", "side", "set", "n", "fragment", "grams")
    counts = parts.groupBy("bin", "fragment").applyInArrow(partial_counts, PARTIAL)
    links = written(
        counts.groupBy("bin").applyInArrow(linked(percent), "set long, root long, links long"), "gram-links"
    )
    roots = components(links.select(F.col("set").alias("a"), F.col("root").alias("b")))

    degree = links.groupBy("set").agg(F.sum("links").alias("n_links"))
    named = (
        classes.join(roots, classes["set"] == roots["vertex"], "left")
        .join(degree, "set", "left")
        .select("set", "first", F.coalesce("component", "set").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    named = written(named, "gram-components")
    keepers = named.groupBy("component").agg(F.min("first").alias("keep"))
    named = named.join(keepers, "component").select("set", "keep", "n_links")
    alone = F.col("set").isNull()
    return rows.join(named, "set", "left").select(
        "doc_id",
        ROW_KEY,
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col(ROW_KEY) == F.col(f"keep.{ROW_KEY}")))).alias("keeper"),
    )


def keep_one(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: one of each component stays, and a repeated row stays once."""
    gone = ngram_components(documents, size, percent).where(~F.col("keeper"))
    kept = without_rows(documents, gone)
    return kept.withColumn(ROW_KEY, row_key()).dropDuplicates(["doc_id", ROW_KEY]).select(*documents.columns)
