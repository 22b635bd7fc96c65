"""Fixity audit of archive replicas with Merkle trees.

A replica's manifest lists its records by offset: length and SHA-256. Ranges of
SPAN bytes of the offset space are the leaves of a tree; a leaf hashes the offsets,
lengths and digests of the records that begin in it, in order, and a node hashes
its FANOUT children that exist. Two replicas with one root hold the same records.
Otherwise the audit goes down: at each level it reads only the children of nodes
that differ, and in the end only the records of ranges that differ.

A leaf has a bounded number of records, since records don't overlap, and a node a
bounded number of children, so no group grows with the archive. Equal records that
repeat in the source are one run with a number of copies, so many copies are one
row. Null fields are told from empty ones; an empty archive has no root, and
differs from any other in all its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.shared import written

SPAN = 1 << 18
FANOUT = 16


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as the text of a WARC response record."""
    absent = F.concat(
        *(F.when(x.isNull(), F.lit(f"X-Absent: {n}\r\n")).otherwise("") for n, x in (("url", url), ("html", html)))
    )
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: "),
        F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit("\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\n"),
        absent,
        F.lit("Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def lay_out(records: DataFrame, order: str) -> DataFrame:
    """Records (``order``, length, digest and more) with their offset in one archive, by ``order`` (nulls first), then digest.

    Equal records become one row with ``copies``. Rows are range-partitioned and
    summed up within their partition; each partition begins where those before
    it end, which takes one row per partition."""
    runs = records.groupBy(*records.columns).agg(F.count("*").alias("copies"))
    runs = written(runs.repartitionByRange(order, "digest").withColumn("part", F.spark_partition_id()), "archive-order")
    size = F.col("length") * F.col("copies")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy("part").agg(F.sum(size).alias("bytes"))
    starts = starts.select(F.col("part").alias("of"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy(order, "digest").rowsBetween(Window.unboundedPreceding, 0)
    placed = runs.join(starts, F.col("part") == F.col("of")).withColumn("offset", F.col("start") + F.sum(size).over(within) - size)
    return written(placed.drop("part", "of", "start"), "archive-manifest")


def _hash(entries: Column) -> Column:
    return F.sha2(F.array_join(entries, "\n"), 256)


class Tree:
    """Levels of (node, hash), the leaves first; the last has the root, if there is one."""

    def __init__(self, manifest: DataFrame, height: int) -> None:
        entry = F.struct("offset", F.concat_ws(" ", "offset", "length", "copies", "digest").alias("line"))
        listed = F.array_sort(F.collect_list(entry))
        leaves = manifest.groupBy(F.floor(F.col("offset") / SPAN).alias("node")).agg(_hash(listed["line"]).alias("hash"))
        self.levels = [written(leaves, "merkle-level")]
        for _ in range(height):
            children = F.array_sort(F.collect_list(F.struct("node", F.concat_ws(" ", "node", "hash").alias("line"))))
            above = F.floor(F.col("node") / FANOUT).alias("parent")
            parents = self.levels[-1].groupBy(above).agg(_hash(children["line"]).alias("hash"))
            self.levels.append(written(parents.withColumnRenamed("parent", "node"), "merkle-level"))

    def root(self) -> str | None:
        row = self.levels[-1].first()
        return row["hash"] if row else None


def height(*manifests: DataFrame) -> int:
    """Levels above the leaves, the same for all replicas."""
    last = max((m.agg(F.max("offset")).first()[0] or 0) // SPAN for m in manifests)
    levels = 0
    while last:
        last, levels = last // FANOUT, levels + 1
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """The nodes whose hashes differ, or that one side lacks."""
    other = b.select(F.col("node").alias("other"), F.col("hash").alias("other_hash"))
    both = a.join(other, F.col("node") == F.col("other"), "full")
    return both.where(~F.col("hash").eqNullSafe(F.col("other_hash"))).select(F.coalesce("node", "other").alias("node"))


def differing_ranges(a: Tree, b: Tree) -> DataFrame:
    """(node) of the leaves that differ."""
    suspects = _differing(a.levels[-1], b.levels[-1])
    for level in range(len(a.levels) - 2, -1, -1):
        parents = written(suspects.select(F.col("node").alias("parent")), "merkle-suspects")
        below = [
            t.levels[level].join(parents, F.floor(F.col("node") / FANOUT) == F.col("parent"), "left_semi") for t in (a, b)
        ]
        suspects = _differing(*below)
    return written(suspects, "merkle-suspects")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """One row for each offset where two manifests (offset, length, copies, digest) differ.

    offset, status (missing, extra or changed), and both sides' columns as structs
    ``original`` and ``replica``, null where a side has no record."""
    levels = height(original, replica)
    trees = Tree(original, levels), Tree(replica, levels)
    if trees[0].root() == trees[1].root():
        ranges = trees[0].levels[0].select("node").limit(0)
    else:
        ranges = differing_ranges(*trees)
    sides = []
    for manifest, name in ((original, "original"), (replica, "replica")):
        here = manifest.join(ranges, F.floor(F.col("offset") / SPAN) == F.col("node"), "left_semi")
        sides.append(here.select(F.col("offset").alias(f"at_{name}"), F.struct(*manifest.columns).alias(name)))
    both = sides[0].join(sides[1], F.col("at_original") == F.col("at_replica"), "full")
    same = (F.col("original.digest") == F.col("replica.digest")) & (F.col("original.length") == F.col("replica.length"))
    same &= F.col("original.copies") == F.col("replica.copies")
    status = F.when(F.col("replica").isNull(), "missing").when(F.col("original").isNull(), "extra").when(~same, "changed")
    return (
        both.select(F.coalesce("at_original", "at_replica").alias("offset"), status.alias("status"), "original", "replica")
        .where(F.col("status").isNotNull())
    )
