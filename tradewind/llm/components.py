"""Connected components as rounds of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) with ``least``, the smallest of a and the b's it has.

    An aggregation and a join, so a vertex with very many edges is summed up by
    the tasks that read them, and its join key can be split."""
    least = edges.groupBy("a").agg(F.min("b").alias("least_b"))
    return edges.join(least, "a").select("a", "b", F.least("a", "least_b").alias("least"))


def _pairs(*columns: Column) -> Column:
    return F.inline(F.array(*columns))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex in ``edges`` (a, b: long); a component is named by its smallest vertex.

    Alternates two steps until the edges stand still: every vertex hands its
    larger neighbours, then its smaller ones, to the smallest vertex it knows.
    The edges end as stars, after about log(n) rounds. Edges of a vertex to
    itself and repeated edges change nothing; no edges give no rows."""

    def pair(a: str, b: str) -> Column:
        return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))

    stars = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = stars.select(_pairs(pair("a", "b"), pair("b", "a")))
        large = _least_neighbour(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
        small = _least_neighbour(down).select(_pairs(pair("b", "least"), pair("a", "least")))
        stars = written(small.where("a != b").distinct(), "edges")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return stars.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(stars.select("b", "b").distinct())
