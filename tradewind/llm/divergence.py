"""Source divergence audit: how far the word choice of the sources of a language differs, in exact whole numbers.

A term is a run of letters (ASCII letters, A-Z in lower case, and all characters
beyond ASCII). A language keeps the terms in at least LEAST of its documents. With
V kept terms and N their occurrences in a group, a term counted c times has the
share p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and two shares differ by
f(p, q) = floor((p - q)^2 / (p + q)).

The divergence of two sources is the sum of f over all kept terms. Most terms are
missing in one of the two, so with p0 the share of a count of zero

    sum f(pa, pb) = V f(pa0, pb0)
                  + sum over terms of a [f(pa, pb0) - f(pa0, pb0)], and over terms of b alike
                  + sum over terms of both [f(pa, pb) - f(pa, pb0) - f(pa0, pb) + f(pa0, pb0)]

The second line comes from how often each count occurs in a source. The third comes
from a frequent-pattern tree: a term's nonzero counts, most frequent source first,
are a path; equal rows are inserted once with their multiplicity, and each node adds
its correction with each of its ancestors once, times the terms that pass through
it. Rows are sorted and dealt by ranges of paths, so that a task holds neighbouring
branches; the sums do not depend on where a branch is cut, and no language, source
or term is bound to one task. The tree's rows cost the square of a term's sources at
most, as does the result, which has a row for every two sources of a language.

A row is a document. Null text, language and source are empty strings. Groups without
terms and languages without kept terms have rows too (value 0 without kept terms).
An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.runs import binary, dictionary, letter_table, pieces, spans
from tradewind.llm.shared import written
from tradewind.llm.words import text_buffers

#: Documents that a kept term occurs in, at least.
LEAST = 10
#: Terms listed for each group.
TERMS = 10
#: Bytes of text worked on at a time, rows of counts held in a task before they are added up, and items of paths made
#: into a tree at a time.
PIECE = 1 << 20
HELD = 1 << 18
ITEMS = 1 << 18

COUNTS_AS = letter_table(np.r_[0x00:0x41, 0x5B:0x61, 0x7B:0x80])


def document_terms(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By pieces of the texts: (terms, and per text and term: the text's place, the term's, occurrences, whether the
    text had not shown it in an earlier piece)."""
    data, at = text_buffers(texts)

    def cuts(low: int, high: int) -> np.ndarray:
        found = np.flatnonzero(COUNTS_AS[data[low:high]] == 0) + low
        return found[found > low]

    before: tuple[int, list] = (-1, [])  # a text that goes on, and its terms so far
    for low, high in pieces(at, cuts, PIECE):
        key = COUNTS_AS[data[low:high]]
        inside = key != 0
        start, stop = spans(inside, at[(at > low) & (at < high)] - low)
        code, terms = dictionary(binary(key[inside], np.r_[0, np.cumsum(stop - start)]))
        owner = np.searchsorted(at, start + low, "right") - 1
        pair, n = np.unique(owner * max(1, len(terms)) + code, return_counts=True)
        owner, code = np.divmod(pair, max(1, len(terms)))
        new = np.ones(len(pair), bool)
        for seen in before[1]:
            known = pc.is_in(terms, value_set=seen).to_numpy(zero_copy_only=False)
            new &= (owner != before[0]) | ~known[code]
        last = int(np.searchsorted(at, high, "right")) - 1
        if high in at:
            before = (-1, [])
        else:
            shown = terms.take(pa.array(code[(owner == last) & new]))
            before = (last, [pa.concat_arrays([*(before[1] if before[0] == last else []), shown])])
        yield terms, owner, code, n, new


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences and documents of every term in every group; partial sums."""

    def added(parts: list) -> pa.Table:
        table = pa.concat_tables(parts).group_by(["group", "term"]).aggregate([("n", "sum"), ("documents", "sum")])
        return table.select(["group", "term", "n_sum", "documents_sum"]).rename_columns(["group", "term", "n", "documents"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held: list[pa.Table] = []

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            names = list(groups)
            for name, k in (("source", 1), ("lang", 0)):
                column = pa.array([x[k] for x in names], pa.string()).take(table.column("group").combine_chunks())
                table = table.add_column(0, name, column)
            table = table.set_column(3, "term", table.column("term").cast(pa.string()))
            return table.drop_columns(["group"]).combine_chunks().to_batches(max_chunksize=1 << 16)

        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("lang", "source"))
            of = np.array([groups.setdefault(x, len(groups)) for x in zip(*columns, strict=True)], np.int64)
            for terms, owner, code, n, new in document_terms(batch.column("text")):
                pair, place = np.unique(of[owner] * max(1, len(terms)) + code, return_inverse=True)
                group, term = np.divmod(pair, max(1, len(terms)))
                sums = (np.bincount(place, x, len(pair)).astype(np.int64) for x in (n, new))
                columns = [pa.array(group), terms.take(pa.array(term)), *map(pa.array, sums)]
                held.append(pa.table(columns, names=["group", "term", "n", "documents"]))
                if sum(map(len, held)) > HELD:
                    held = [added(held)]
                    if len(held[0]) > HELD // 2:
                        yield from out(held.pop())
                    pa.default_memory_pool().release_unused()
        if held:
            yield from out(added(held))

    rows = documents.select("lang", "source", "text")
    return rows.mapInArrow(counted, "lang string, source string, term string, n long, documents long")


def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 count / total) for count <= total, three digits at a time: exact up to totals of 9 * 10^15."""
    total = F.greatest(total, F.lit(1).cast("long"))
    value, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        value, rest = value * 1000 + div(rest * 1000, total), rest * 1000 % total
    return value + 1


def differ(p: Column, q: Column) -> Column:
    return div((p - q) * (p - q), p + q)


def kept_terms(documents: DataFrame) -> DataFrame:
    """(lang, term, n, counts: array of struct(source, n))."""
    by_source = term_counts(documents).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    kept = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("counts"), F.sum("documents").alias("documents")
    )
    return written(kept.where(F.col("documents") >= LEAST).drop("documents"), "kept-terms")


def group_totals(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per group: lang, source, place (most occurrences first), total (N + 2 V), zero (the share of a count of 0),
    n_terms (V), lang_total."""
    occurrences = terms.select("lang", F.explode("counts").alias("of")).groupBy("lang", "of.source").agg(F.sum("of.n").alias("n"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("lang_n"))
    zero = F.lit(0).cast("long")
    n, n_terms, lang_n = (F.coalesce(x, zero) for x in ("n", "n_terms", "lang_n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(n.desc(), "source"))
    groups = (
        documents.select("lang", "source")
        .distinct()
        .join(occurrences, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select("lang", "source", place.alias("place"), (n + 2 * n_terms).alias("total"), n_terms.alias("n_terms"),
                (lang_n + 2 * n_terms).alias("lang_total"))
    )
    return written(groups.withColumn("zero", share(F.lit(2).cast("long"), F.col("total"))), "term-groups")


def tree_corrections(lang: np.ndarray, at: np.ndarray, place: np.ndarray, p: np.ndarray, zero: np.ndarray, n: np.ndarray):
    """The corrections of both-present terms from the tree of some sorted rows: arrays (lang, a, b, value), summed.

    Row k, of language ``lang[k]`` and ``n[k]`` terms, is the path of items at[k] to at[k + 1]."""
    length, node = np.diff(at), lang.copy()
    keys, values, held = [], [], 0
    width = int(place.max(initial=0)) + 1

    def f(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x - y) ** 2 // (x + y)

    def compress() -> None:
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        keys[:], values[:] = [key[order][first]], [np.add.reduceat(value[order], first)]

    for depth in range(int(length.max(initial=0))):
        row = np.flatnonzero(length > depth)
        item = at[row] + depth
        # Rows are sorted, so those of a node are neighbours: its parent and its item tell it from the row before.
        new = np.r_[True, (np.diff(node[row]) != 0) | (np.diff(place[item]) != 0) | (np.diff(p[item]) != 0)]
        node[row] = np.cumsum(new)
        first = np.flatnonzero(new)
        passing, head, own = np.add.reduceat(n[row], first), at[row[first]], item[first]
        for above in range(depth):
            other = head + above
            both = f(p[other], p[own]) - f(p[other], zero[own]) - f(zero[other], p[own]) + f(zero[other], zero[own])
            keys.append((lang[row[first]] * width + place[other]) * width + place[own])
            values.append(both * passing)
            held += len(own)
            if held > ITEMS:
                compress()
                held = len(keys[0])
    if not keys:
        return [np.empty(0, np.int64)] * 4
    compress()
    rest, b = np.divmod(keys[0], width)
    return [*np.divmod(rest, width), b, values[0]]


def both_present(entries: DataFrame) -> DataFrame:
    """(lang, a, b, value): the corrections of the terms that two sources share, by trees of their paths; partial sums."""
    item = F.struct("place", "p", "zero")
    paths = entries.groupBy("lang", "term").agg(F.array_sort(F.collect_list(item)).alias("path"))
    rows = paths.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count("*").alias("n"))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lang, names = dictionary(table.column("lang").combine_chunks())
            path = table.column("path").combine_chunks()
            at = path.offsets.to_numpy().astype(np.int64)
            items = path.flatten()
            fields = (items.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("place", "p", "zero"))
            of, a, b, value = tree_corrections(lang, at - at[0], *fields, table.column("n").to_numpy())
            return pa.RecordBatch.from_arrays([names.take(pa.array(of)), *map(pa.array, (a, b, value))], ["lang", "a", "b", "value"])

        held, items = [], 0
        for batch in batches:
            held.append(batch)
            items += len(batch.column("path").flatten())
            if items > ITEMS:
                yield out(held)
                held, items = [], 0
        if held:
            yield out(held)

    ordered = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ordered.mapInArrow(trees, "lang string, a long, b long, value long")


def source_pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of every two sources of a language, in both directions."""
    one, two = groups.alias("one"), groups.alias("two")
    # One row for every two sources, as many as the result has.
    pairs = one.join(two, (F.col("one.lang") == F.col("two.lang")) & (F.col("one.place") < F.col("two.place"))).select(
        F.col("one.lang").alias("lang"),
        F.col("one.place").cast("long").alias("a"),
        F.col("two.place").cast("long").alias("b"),
        F.col("one.source").alias("source_a"),
        F.col("two.source").alias("source_b"),
        (F.col("one.n_terms") * differ(F.col("one.zero"), F.col("two.zero"))).alias("empty"),
    )
    alike = entries.groupBy("lang", "place", "p", "zero").agg(F.count("*").alias("n"))
    other = groups.select("lang", F.col("place").alias("other"), F.col("zero").alias("other_zero"))
    single = alike.join(other, "lang").where("place <> other").select(
        "lang",
        F.least("place", "other").cast("long").alias("a"),
        F.greatest("place", "other").cast("long").alias("b"),
        (F.col("n") * (differ(F.col("p"), F.col("other_zero")) - differ(F.col("zero"), F.col("other_zero")))).alias("value"),
    )
    corrections = single.unionByName(both_present(entries)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    value = F.col("empty") + F.coalesce("value", F.lit(0))
    sides = F.array(
        *(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("source_a", "source_b"), ("source_b", "source_a")))
    )
    return pairs.join(corrections, ["lang", "a", "b"], "left").select("lang", value.alias("value"), F.explode(sides).alias("side")).select(
        "lang", "side.source", "side.item", "value"
    )


def audit(documents: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the other sources of the language by falling divergence;
    part ``term``: the TERMS terms that a group uses most beyond its language (both shares from the kept terms)."""
    rows = documents.select(*(F.coalesce(x, F.lit("")).alias(x) for x in ("lang", "source", "text")))
    terms = kept_terms(rows)
    groups = group_totals(rows, terms)
    count = F.col("n").cast("long") + 2
    entries = written(
        terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("counts").alias("of"))
        .select("lang", "term", "lang_n", "of.source", "of.n")
        .join(groups, ["lang", "source"])
        .select("lang", "term", "source", "place", "zero", share(count, F.col("total")).alias("p"),
                share(F.col("lang_n") + 2, F.col("lang_total")).alias("q")),
        "term-shares",
    )
    more = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), differ(F.col("p"), F.col("q")).alias("value"))

    def ranked(part: str, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked("pair", source_pairs(entries, groups)).unionByName(ranked("term", more).where(F.col("rank") <= TERMS))
