"""Benchmark decontamination with a positional inverted index of the corpus.

The corpus is cut into segments of whole documents. A segment stores, for every
term that the test items use, the sorted positions at which its documents have
it; the segments are written as a table and spread over the tasks, so no list
crosses the network. Searching takes, for each phrase, the positions of its
rarest term (by corpus count), shifts them back by the term's offset, and keeps
those also found in the shifted lists of its other terms, rarer ones first.

Null and empty texts have no words; an item without words has no window. Rows
that repeat an id are told apart by their place in the index. Items are searched
in groups of bounded size, so neither the driver nor a task holds them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import ROW_KEY, keyed, without_rows, written
from tradewind.llm.words import NOT_ALPHANUMERIC, byte_values, slices, words

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: Words of a segment, and of the items searched in one go.
SEGMENT_WORDS = 1 << 19
ITEM_WORDS = 1 << 20
#: Free positions between two documents, so that no match spans them.
GAP = 1 << 10
#: Candidate positions worked on at a time.
CANDIDATES = 1 << 21

VALUES = byte_values(NOT_ALPHANUMERIC)
HIGH = np.uint64(32)


class Phrases:
    """Word sequences to look for: terms by place in the vocabulary, -1 beyond a phrase's end."""

    def __init__(self, items: list, texts: list[str | None], width: int) -> None:
        numbers, counts = words(pa.array(texts, pa.string()), VALUES)
        self.vocabulary = np.unique(numbers)
        places = np.searchsorted(self.vocabulary, numbers).astype(np.int64)
        rows, owners, low = [], [], 0
        for item, n in enumerate(counts):
            own, low = places[low : low + n], low + n
            if 0 < n < width:
                rows.append(np.r_[own, np.full(width - n, -1)][None, :])
            elif n:
                rows.append(np.lib.stride_tricks.sliding_window_view(own, width))
            owners += [item] * (max(1, n - width + 1) if n else 0)
        self.terms = np.concatenate(rows) if rows else np.empty((0, width), np.int64)
        self.owner = np.array(owners, np.int64)
        self.items = items

    def rarest_first(self, counts: np.ndarray) -> None:
        """The order in which a phrase's lists are intersected."""
        frequency = np.where(self.terms < 0, np.iinfo(np.int64).max, counts[self.terms])
        self.offsets = np.argsort(frequency, axis=1, kind="stable")
        self.ordered = np.take_along_axis(self.terms, self.offsets, 1)
        self.length = (self.terms >= 0).sum(axis=1)


INDEX = (
    "segment long, doc_ids array<long>, row_keys array<long>, n_words array<long>, "
    "terms binary, counts binary, positions binary"
)


def build_index(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Write the segments of ``documents`` (doc_id, text): positions of the terms in ``vocabulary``."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            numbers, counts = words(batch.column("text"), VALUES)
            ends = np.r_[0, np.cumsum(counts)]
            for low, high in slices(counts, SEGMENT_WORDS):
                own = numbers[ends[low] : ends[high]]
                place = np.searchsorted(vocabulary, own)
                place[place == len(vocabulary)] = 0
                known = np.flatnonzero(vocabulary[place] == own) if len(vocabulary) else np.empty(0, np.int64)
                owner = np.repeat(np.arange(high - low), counts[low:high])
                key = (place[known].astype(np.uint64) << HIGH) | (known + owner[known] * GAP).astype(np.uint64)
                key.sort()
                terms, sizes = np.unique(key >> HIGH, return_counts=True)
                lists = [pa.array([batch.column(x)[low:high]], pa.list_(pa.int64())) for x in ("doc_id", ROW_KEY)]
                blobs = [terms.astype("<u4"), sizes.astype("<u4"), key.astype("<u4")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        *lists,
                        pa.array([counts[low:high].tolist()], pa.list_(pa.int64())),
                        *(pa.array([x.tobytes()], pa.binary()) for x in blobs),
                    ],
                    ["segment", "doc_ids", "row_keys", "n_words", "terms", "counts", "positions"],
                )
                number += 1

    return written(keyed(documents).mapInArrow(segments, INDEX), "positional-index")


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Corpus count of every term of the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms"), batch.column("counts"), strict=True):
                total[np.frombuffer(terms.as_py(), "<u4")] += np.frombuffer(counts.as_py(), "<u4")
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["term", "n"])

    found = index.select("terms", "counts").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = np.zeros(n_terms, np.int64)
    for term, n in found.collect():  # at most one row for each word of a group of items
        total[term] = n
    return total


class Segment:
    """One segment's lists as sorted (term, position) keys."""

    def __init__(self, row: dict) -> None:
        terms, sizes = np.frombuffer(row["terms"], "<u4"), np.frombuffer(row["counts"], "<u4")
        self.keys = (np.repeat(terms.astype(np.uint64), sizes) << HIGH) | np.frombuffer(row["positions"], "<u4")
        counts = np.array(row["n_words"], np.int64)
        self.first = np.cumsum(counts) - counts + np.arange(len(counts)) * GAP
        self.doc_ids, self.row_keys, self.number = row["doc_ids"], row["row_keys"], row["segment"]

    def range_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = terms.astype(np.uint64) << HIGH
        return np.searchsorted(self.keys, low), np.searchsorted(self.keys, low + (np.uint64(1) << HIGH))

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        want = (terms.astype(np.uint64) << HIGH) | positions.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return self.keys[at] == want

    def candidates(self, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, position of its rarest term), in pieces of bounded size."""
        if not len(self.keys) or not len(phrases.terms):
            return
        low, high = self.range_of(phrases.ordered[:, 0])
        there = np.flatnonzero(high > low)
        for a, b in slices((high - low)[there], CANDIDATES):
            some = there[a:b]
            n = high[some] - low[some]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(some, n), (self.keys[np.repeat(low[some], n) + within] & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def exact(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first position) of every exact occurrence."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for phrase, position in self.candidates(phrases):
            start = position - phrases.offsets[phrase, 0]
            keep = start >= 0
            phrase, start = phrase[keep], start[keep]
            done = []
            for k in range(1, phrases.terms.shape[1]):
                whole = phrases.length[phrase] <= k
                done.append((phrase[whole], start[whole]))
                phrase, start = phrase[~whole], start[~whole]
                keep = self.has(phrases.ordered[phrase, k], start + phrases.offsets[phrase, k])
                phrase, start = phrase[keep], start[keep]
            found += [*done, (phrase, start)]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    def near(self, phrases: Phrases, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first position) of every stretch of ``within`` words that has all its terms, in any order.

        A stretch begins at one of the phrase's terms."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for phrase, position in self.candidates(phrases):
            for back in range(within):
                start, some = position - back, phrase
                keep = start >= 0
                start, some = start[keep], some[keep]
                begins = np.zeros(len(start), bool)
                for k in range(phrases.terms.shape[1]):
                    term = phrases.ordered[some, k]
                    want = (np.maximum(term, 0).astype(np.uint64) << HIGH) | start.astype(np.uint64)
                    at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                    got = self.keys[at]
                    here = (got >= want) & (got - want < np.uint64(within)) & (got >> HIGH == want >> HIGH)
                    begins |= (term >= 0) & (got == want)
                    keep = (term < 0) | here
                    some, start, begins = some[keep], start[keep], begins[keep]
                found.append((some[begins], start[begins]))
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


HITS = "segment long, place int, item_id long, first long, last long"


def search(index: DataFrame, phrases: Phrases, within: int | None = None) -> DataFrame:
    """One row per matched stretch: its document (segment, place), item and words first to last.

    Overlapping matches of an item in a document are one stretch. ``within``
    (at most GAP) asks for proximity instead of exact matches.
    """
    if within is not None and not 0 < within <= GAP:
        raise ValueError(f"within must be from 1 to {GAP}")

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                segment = Segment({k: batch.column(k)[n].as_py() for k in batch.schema.names})
                phrase, start = segment.exact(phrases) if within is None else segment.near(phrases, within)
                if not len(phrase):
                    continue
                stop = start + (phrases.length[phrase] if within is None else within)
                place = np.searchsorted(segment.first, start, "right") - 1
                order = np.lexsort((start, phrases.owner[phrase], place))
                place, owner, start, stop = place[order], phrases.owner[phrase][order], start[order], stop[order]
                new = np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]
                reach = np.maximum.accumulate(stop + np.cumsum(new) * (1 << 40)) - np.cumsum(new) * (1 << 40)
                new[1:] |= start[1:] > reach[:-1]
                heads = np.flatnonzero(new)
                tails = np.r_[heads[1:], len(new)] - 1
                base = segment.first[place[heads]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(heads), segment.number)),
                        pa.array(place[heads].astype(np.int32)),
                        pa.array([phrases.items[x] for x in owner[heads]], pa.int64()),
                        pa.array(start[heads] - base),
                        pa.array(reach[tails] - base - 1),
                    ],
                    ["segment", "place", "item_id", "first", "last"],
                )

    return index.mapInArrow(hits, HITS)


def item_groups(items: DataFrame) -> Iterator[tuple[list, list]]:
    """The items (item_id, text) in groups of about ITEM_WORDS words."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-total // (4 * ITEM_WORDS)))
    for n in range(groups):
        rows = items.select("item_id", "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == n).collect()
        yield [r[0] for r in rows], [r[1] for r in rows]


def matches(documents: DataFrame, items: DataFrame, width: int = WINDOW, within: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(a row per document: segment, place, doc_id, row key, n_words; the matched stretches as in ``search``)."""
    found = index = None
    for ids, texts in item_groups(items):
        phrases = Phrases(ids, texts, width)
        index = build_index(documents, phrases.vocabulary)
        phrases.rarest_first(term_counts(index, len(phrases.vocabulary)))
        part = search(index, phrases, within)
        found = part if found is None else found.unionByName(part)
    rows = index.select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", "row_keys", "n_words")).alias("place", "doc")
    ).select(
        "segment", "place", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.row_keys").alias(ROW_KEY),
        F.col("doc.n_words").alias("n_words"),
    )
    return rows, found


def contamination(documents: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, row key, n_words, n_hit words inside matches, and the items matched."""
    rows, found = matches(documents, items, width)
    stretches = F.array_sort(F.collect_list(F.struct("first", "last")))
    # The union of the stretches: a sorted walk that counts what lies beyond the last word seen.
    covered = F.aggregate(
        stretches,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("seen")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"] - 1, acc["seen"]))).alias("n"),
            F.greatest(acc["seen"], x["last"]).alias("seen"),
        ),
        lambda acc: acc["n"],
    )
    hit = found.groupBy("segment", "place").agg(covered.alias("n_hit"), F.collect_set("item_id").alias("items"))
    return rows.join(hit, ["segment", "place"], "left").select(
        "doc_id",
        ROW_KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
    )


def decontaminate(documents: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents without a passage of any item, with their own columns."""
    found = contamination(documents, items, width).where(F.col("n_hit") > 0)
    return without_rows(documents, found.select("doc_id", ROW_KEY))
