"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. An inserted or
deleted letter changes one letter count by one, a replaced one changes two, so the
count vectors of near words are at L1 distance 1 or 2. For each pair of lengths
(the same; one more) the words of one length ask the k-d tree of the other: a box
goes on only if the counts that its vectors lack or exceed stay within the edit.
Vectors that fit are then compared in the order of their letters.

A top tree, fitted on at most SAMPLE words, deals the words of a large vocabulary to
cells: a word is a point of the one cell whose box it lies in, and asks every cell
that the box test admits for either length. A leaf that holds or is asked too much
(words with the same letters can't be parted by their counts) is a rectangle of
cells: a point meets each part of the askers, an asker each part of the points. So
every pair meets exactly once, in a group of bounded size, and only the bounded
sample and its tree, a box for some thousand words, pass through the driver.

Each two near words are found once, by the shorter one or the one that loses the
smaller letter. Two vectors' words are matched by the 64-bit number of what an edit
leaves, not each with each.

To plant variants, ``word_counts`` takes one code point out of the runs of a document
whose crc32 a divisor divides. Null texts have no runs; a null id reads as empty; a
run of one code point that is taken out leaves nothing. Repeated rows count each. An
empty table has no words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.runs import binary, dictionary, pieces, spans
from tradewind.llm.shared import written
from tradewind.llm.words import BASE, mixed, powers, text_buffers

#: Shortest words, and their least number of occurrences.
LENGTH, LEAST = 6, 5
#: Runs whose number this divides lose a code point.
EVERY = 199
#: A word's form occurs this many times as often.
RATIO = 5
#: Words that the top tree is fitted on, words of a cell, and words that ask it.
SAMPLE, CELL, ASKERS = 200_000, 1 << 13, 1 << 17
#: Vectors of a leaf of a cell's tree, and askers compared with one at a time.
LEAF, BLOCK = 32, 1 << 11
#: Rows of counts held in a task before they are added up.
HELD = 1 << 20
#: Letters looked at together when words are matched.
MATCHED = 1 << 22
#: Runs longer than this are hashed one by one.
LONG = 64

LETTERS = np.r_[0x61:0x7B, 0xC0:0x100].astype(np.uint8)
PLACE = np.zeros(256, np.int64)
PLACE[LETTERS] = np.arange(len(LETTERS))
#: The length is one more dimension, so stretched that no other length fits a box.
STRETCH = 4
VALUES = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)

CRC_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_STEP = np.where(CRC_STEP & 1, (CRC_STEP >> 1) ^ np.uint32(0xEDB88320), CRC_STEP >> 1)


# Words and their counts


def run_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of a valid UTF-8 text belong to a run: ASCII letters, and both bytes of U+00C0 to U+00FF."""
    lead = data == 0xC3
    inside = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80) | lead
    inside[1:] |= lead[:-1]
    return inside


def text_runs(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """By pieces of the texts: (distinct runs, and per text and run: the text's place, the run's, occurrences)."""
    data, at = text_buffers(texts)

    def cuts(low: int, high: int) -> np.ndarray:
        part = data[low:high]
        begins = (part < 0x80) | (part >= 0xC0)
        found = np.flatnonzero(begins & ~run_bytes(part)) + low
        return found[found > low]

    for low, high in pieces(at, cuts):
        part = data[low:high]
        inside = run_bytes(part)
        start, stop = spans(inside, at[(at > low) & (at < high)] - low)
        lower = np.where((part >= 0x41) & (part <= 0x5A), part | 0x20, part)
        code, runs = dictionary(binary(lower[inside], np.r_[0, np.cumsum(stop - start)]))
        owner = np.searchsorted(at, start + low, "right") - 1
        pair, n = np.unique(owner * max(1, len(runs)) + code, return_counts=True)
        yield runs, *np.divmod(pair, max(1, len(runs))), n


def numbers(prefixes: list[bytes], runs: pa.Array, owner: np.ndarray, code: np.ndarray) -> np.ndarray:
    """crc32 of prefix and run for every pair: a prefix's register is moved over the run's length, then the run's is added."""
    plain = runs.to_pylist()
    own = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain))
    length = np.fromiter(map(len, plain), np.int64, len(plain))[code]
    register = np.fromiter(map(zlib.crc32, prefixes), np.uint32, len(prefixes))[owner]
    order = np.argsort(-length, kind="stable")
    moved, falling = register[order], -length[order]
    for k in range(min(LONG, -int(falling.min(initial=0)))):
        count = int(np.searchsorted(falling, -k))  # runs longer than k
        moved[:count] = (moved[:count] >> np.uint32(8)) ^ CRC_STEP[moved[:count] & np.uint32(0xFF)]
    found = np.empty_like(moved)
    found[order] = moved
    found ^= own[code]
    for k in np.flatnonzero(length > LONG):
        found[k] = zlib.crc32(prefixes[owner[k]] + plain[code[k]])
    return found


def word_counts(documents: DataFrame, every: int = EVERY, length: int = LENGTH, least: int = LEAST) -> DataFrame:
    """(word, n): the words of at least ``length`` code points and ``least`` occurrences."""

    def added(parts: list) -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            prefixes = [b"%s:" % (x or "").encode() for x in batch.column("doc_id").to_pylist()]
            for runs, owner, code, n in text_runs(batch.column("text")):
                number = numbers(prefixes, runs, owner, code)
                cut = np.flatnonzero(number % np.uint32(every) == 0)
                variants = []
                for run, at in zip(runs.take(pa.array(code[cut])).cast(pa.string()).to_pylist(), number[cut].tolist(), strict=True):
                    variants.append(run[: at % len(run)] + run[at % len(run) + 1 :])
                n = n.astype(np.int64)
                whole = np.bincount(code, n, len(runs)).astype(np.int64) - np.bincount(code[cut], n[cut], len(runs)).astype(np.int64)
                words = pa.concat_arrays([runs.cast(pa.string()), pa.array(variants, pa.string())])
                found = pa.table([words, pa.array(np.r_[whole, n[cut]])], names=["word", "n"])
                long = pc.greater_equal(pc.utf8_length(found["word"]), length)
                held.append(found.filter(pc.and_(long, pc.greater(found["n"], 0))))
                if sum(map(len, held)) > HELD:
                    held = [added(held)]
                    if len(held[0]) > HELD // 2:
                        yield from held.pop().combine_chunks().to_batches(max_chunksize=1 << 16)
        if held:
            yield from added(held).combine_chunks().to_batches(max_chunksize=1 << 16)

    counts = documents.select(F.col("doc_id").cast("string"), "text").mapInArrow(counted, "word string, n long")
    return written(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")


# Trees over letter counts


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row for each word (Latin-1): how often it has each letter."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    at = PLACE[np.frombuffer(b"".join(words), np.uint8)]
    flat = np.repeat(np.arange(len(words)) * len(LETTERS), length) + at
    return np.bincount(flat, minlength=len(words) * len(LETTERS)).reshape(-1, len(LETTERS)).astype(np.int32)


class Tree:
    """A k-d tree: a box for every node, children of inner nodes, and the points of leaves."""

    def __init__(self, points: np.ndarray, most: int, tight: bool) -> None:
        """``tight``: boxes around the points; else a partition of the whole space. Leaves hold ``most`` points, if they differ."""
        wide = np.full(points.shape[1], np.iinfo(np.int32).max // 4, np.int32)
        self.low, self.high, self.children, self.members = [], [], [], []
        todo = [(np.arange(len(points)), -wide, wide, -1)]
        while todo:
            at, low, high, parent = todo.pop()
            own = points[at]
            if tight and len(at):
                low, high = own.min(axis=0), own.max(axis=0)
            node = len(self.children)
            if parent >= 0:
                self.children[parent].append(node)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.members.append(at)
            split = self.split(own) if len(at) > most else None
            if split is None:
                continue
            self.members[node] = None
            dimension, threshold = split
            left = own[:, dimension] <= threshold
            left_high, right_low = high.copy(), low.copy()
            left_high[dimension], right_low[dimension] = threshold, threshold + 1
            todo += [(at[left], low, left_high, node), (at[~left], right_low, high, node)]

    @staticmethod
    def split(points: np.ndarray) -> tuple[int, int] | None:
        """The dimension and threshold that part the points most evenly; none if all are equal."""
        middle = np.median(points, axis=0)
        best = []
        for threshold in (np.floor(middle), np.ceil(middle) - 1):
            share = (points <= threshold).mean(axis=0)
            even = np.minimum(share, 1 - share)
            dimension = int(np.argmax(even))
            best.append((even[dimension], dimension, int(threshold[dimension])))
        even, dimension, threshold = max(best)
        return (dimension, threshold) if even > 0 else None

    def leaves(self) -> list[int]:
        return [k for k, x in enumerate(self.members) if x is not None]

    def search(self, asked: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``asked``) where the leaf's box may hold a vector with ``more`` counts more and ``fewer`` less."""
        todo = [(0, np.arange(len(asked)))]
        while todo:
            node, rows = todo.pop()
            x = asked[rows]
            within = np.maximum(self.low[node] - x, 0).sum(axis=1) <= more
            within &= np.maximum(x - self.high[node], 0).sum(axis=1) <= fewer
            rows = rows[within]
            if not len(rows):
                continue
            if self.members[node] is not None:
                yield node, rows
            todo += [(child, rows) for child in self.children[node]]


class Cells:
    """The top tree, and the cells of each of its leaves: parts of its points by parts of its askers."""

    def __init__(self, sample: list[bytes], share: float) -> None:
        points = self.vectors(sample, 0)
        self.tree = Tree(points, max(1, int(CELL * share)), tight=False)
        askers = dict.fromkeys(self.tree.leaves(), 0)
        for _, leaf in self.asked(sample):
            askers[leaf] += 1
        first = 0
        self.first, self.parts = {}, {}
        for leaf, asking in askers.items():
            holding = len(self.tree.members[leaf])
            self.parts[leaf] = math.ceil(max(1, holding) / share / CELL / 2), math.ceil(max(1, asking) / share / ASKERS)
            self.first[leaf] = first
            first += math.prod(self.parts[leaf])
        self.tree.members = [None if x is None else x[:0] for x in self.tree.members]  # the boxes are enough

    @staticmethod
    def vectors(words: list[bytes], longer: int) -> np.ndarray:
        length = np.fromiter(map(len, words), np.int32, len(words)) + longer
        return np.column_stack([letter_counts(words), STRETCH * length]).astype(np.int32)

    def asked(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(place of a word, leaf that it asks)."""
        found = set()
        for longer in (0, 1):
            for leaf, rows in self.tree.search(self.vectors(words, longer), 1, 1 - longer):
                found.update((k, leaf) for k in rows.tolist())
        return sorted(found)

    def dealt(self, words: list[bytes]) -> Iterator[tuple[int, int, bool]]:
        """(place of a word, cell, whether it is a point there or asks)."""
        part = [zlib.crc32(x) for x in words]
        for leaf, rows in self.tree.search(self.vectors(words, 0), 0, 0):
            points, askers = self.parts[leaf]
            for k in rows.tolist():
                yield from ((k, self.first[leaf] + part[k] % points * askers + x, True) for x in range(askers))
        for k, leaf in self.asked(words):
            points, askers = self.parts[leaf]
            yield from ((k, self.first[leaf] + x * askers + part[k] // points % askers, False) for x in range(points))


# Near words


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether ``b``, as long or one longer, is ``a`` with one letter replaced or inserted."""
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


class Words:
    """Words of one length: letters, distinct count vectors, and which words have each."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.vectors, of = np.unique(letter_counts(words), axis=0, return_inverse=True)
        self.order = np.argsort(of.ravel(), kind="stable")
        self.size = np.bincount(of.ravel(), minlength=len(self.vectors))
        self.first = np.cumsum(self.size) - self.size
        power, self.inverse = powers(self.letters.shape[1] + 1)
        self.terms = VALUES[self.letters] * power[: self.letters.shape[1]]
        self.total = self.terms.sum(axis=1, dtype=np.uint64)

    def of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``vectors``, word) of all words with each of these vectors."""
        size = self.size[vectors]
        pair = np.repeat(np.arange(len(vectors)), size)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        return pair, self.order[self.first[vectors][pair] + within]

    def without(self, vectors: np.ndarray, letter: np.ndarray, closed: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, number) of the words with each vector less one letter: its place left empty, or closed up."""
        pair, word = self.of(vectors)
        row, at = np.nonzero(self.letters[word] == letter[pair][:, None])
        pair, word = pair[row], word[row]
        number = self.total[word] - self.terms[word, at]
        if closed:
            before = np.cumsum(self.terms[word], axis=1)[np.arange(len(word)), at] - self.terms[word, at]
            number = before + (number - before) * self.inverse[1]
        return word, mixed(number + pair.astype(np.uint64) * BASE)

    def whole(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair, word = self.of(vectors)
        return word, mixed(self.total[word] + pair.astype(np.uint64) * BASE)


def vector_pairs(asking: Words, points: Words, longer: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(vector that asks, point's vector, letter that goes, letter that comes): one edit by their counts, each two once."""
    used = points.vectors.any(axis=0)
    p = np.column_stack([points.vectors[:, used], np.zeros(len(points.vectors), np.int32)]).astype(np.int16)
    q = np.column_stack([asking.vectors[:, used], asking.vectors[:, ~used].sum(axis=1)]).astype(np.int16)
    tree = Tree(p, LEAF, tight=True)
    for leaf, rows in tree.search(q, 1, 1 - longer):
        members = tree.members[leaf]
        for low in range(0, len(rows), BLOCK):
            change = p[members][None, :, :] - q[rows[low : low + BLOCK]][:, None, :]
            fits = (np.maximum(change, 0).sum(axis=2) == 1) & (np.maximum(-change, 0).sum(axis=2) == 1 - longer)
            a, b = np.nonzero(fits)
            a, b = rows[low + a], members[b]
            change = points.vectors[b] - asking.vectors[a]
            comes, goes = change.argmax(axis=1), change.argmin(axis=1)
            once = np.ones(len(a), bool) if longer else goes < comes
            yield a[once], b[once], LETTERS[goes[once]], LETTERS[comes[once]]


def near_words(asking: Words, points: Words, longer: int) -> Iterator[tuple[int, int]]:
    """(word that asks, point) one edit apart."""
    for a, b, goes, comes in vector_pairs(asking, points, longer):
        # Some vector pairs at a time, by the letters of their words.
        load = np.cumsum((asking.size[a] + points.size[b]) * points.letters.shape[1])
        step = np.searchsorted(load, np.arange(0, load[-1] if len(load) else 0, MATCHED))
        borders = np.unique(np.r_[0, step, len(a)])
        for low, high in zip(borders[:-1], borders[1:], strict=True):
            one = slice(low, high)
            word, left = asking.whole(a[one]) if longer else asking.without(a[one], goes[one], closed=False)
            point, right = points.without(b[one], comes[one], closed=bool(longer))
            if not len(left):
                continue
            # What is left of an asker tells it; several points, or places of one, may leave the same.
            order = np.argsort(left)
            at = order[np.minimum(np.searchsorted(left[order], right), len(left) - 1)]
            same = left[at] == right
            for i, j in sorted(set(zip(word[at[same]].tolist(), point[same].tolist(), strict=True))):
                if one_edit(asking.words[i], points.words[j]):
                    yield i, j


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words that differ by one edit, in both directions. ``words``: (word, n), distinct."""
    total = words.count()
    share = min(1.0, SAMPLE / max(1, total))
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share * (1 << 30)).select("word").collect()
    cells = Cells([r["word"].encode("latin-1") for r in chosen], share)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [x.encode("latin-1") for x in batch.column("word").to_pylist()]
            found = list(cells.dealt(plain))
            at = pa.array([x for x, _, _ in found], pa.int64())
            columns = [pa.array([x for _, x, _ in found], pa.int32()), pa.array([x for _, _, x in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("word").take(at), batch.column("n").take(at)], ["cell", "point", "word", "n"]
            )

    def found(cell: pa.Table) -> pa.Table:
        plain = [x.encode("latin-1") for x in cell.column("word").to_pylist()]
        n, point = cell.column("n").to_pylist(), cell.column("point").to_pylist()
        of: dict[tuple[bool, int], list[int]] = {}
        for k, word in enumerate(plain):
            of.setdefault((point[k], len(word)), []).append(k)
        sides = {key: Words([plain[k] for k in rows]) for key, rows in of.items() if key[0]}
        one, two = [], []
        for (is_point, length), rows in of.items():
            if is_point:
                continue
            for low in range(0, len(rows), CELL):
                some = rows[low : low + CELL]
                asking = None
                for longer in (0, 1):
                    if (True, length + longer) not in sides:
                        continue
                    asking = asking or Words([plain[k] for k in some])
                    for i, j in near_words(asking, sides[True, length + longer], longer):
                        one.append(some[i])
                        two.append(of[True, length + longer][j])
        words, near = [plain[k].decode("latin-1") for k in one + two], [plain[k].decode("latin-1") for k in two + one]
        return pa.table({"word": pa.array(words, pa.string()), "near": pa.array(near, pa.string()),
                         "near_n": pa.array([n[k] for k in two + one], pa.int64())})

    dealt = words.mapInArrow(deal, "cell int, point boolean, word string, n long")
    return dealt.groupBy("cell").applyInArrow(found, "word string, near string, near_n long")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root): the last of a word's forms, which are at most ``steps`` long, by joins that double their reach."""
    found = forms.select("word", F.col("form").alias("root"))
    for k in range(max(0, math.ceil(math.log2(max(1, steps))))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = written(found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"roots-{k}")
    return found


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of the distinct words (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    there = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(there, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(there, -F.col("best.less")).alias("form_n"),
        ),
        "word-forms",
    )
    # A form is ratio times as frequent, so no chain is longer than this.
    ends = formed.agg(F.min("n"), F.max("n")).first()
    steps = math.floor(math.log(max(1, (ends[1] or 1) / (ends[0] or 1)), ratio)) + 1
    last = roots(formed.where(F.col("form").isNotNull()), steps)
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
