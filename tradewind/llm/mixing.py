"""Mixing sources to target sizes with pivotal dependent rounding.

A source's target and size give the copies that each of its documents should
have: a whole number and a fraction. Fractions become 0 or 1 copies in pairs: of
two documents, mass (words) moves at random from one to the other until one has
all or none of its own, in such a way that every expected number of copies and
the mass of the pair stay as they were. Within a group of bounded size the
document left with a fraction meets the next one; the one left over at the end
stands for its group in the next round, where groups of groups meet, up to one
document per source. Documents meet in falling order of size, and a few of each
source wait for the last round, so that the fraction left at the very end is
that of a small one. It is rounded to the nearer copy, not drawn: a source ends
within half a document of its target.

All draws are hashes of ids, and groups are hashes of ids too: results don't
depend on partitions. Rows that share source and id are decided as one, with
their sizes added. Null texts have size 0; a null source is a source, the last.
Documents without words take no part in the rounding (they have no mass) and get
their fraction's copy by a draw of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.shared import let, written

WEIGHTS = (5, 2, 1)
#: The mix's words as a share of all words, and the most copies of a source.
SHARE = 1.5
MOST = 2.0
#: Documents, or groups, that meet in one array.
GROUP = 256
#: About how many documents of a source wait for its last round.
WAITING = 128
WORD = r"[^\x20\x09-\x0D]+"
#: A fraction of a document closer than this to none or all of it is none or all.
EXACT = 1e-9


def document_sizes(documents: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return written(documents.select("doc_id", "source", size.alias("size")), "document-sizes")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size, target, and the groups its documents are dealt to. Windows run over one row per source.

    Words go to sources by weight, up to ``most`` times their size; what is above
    goes to the others by weight. With sources ordered by cap / weight, the level
    that holds for the uncapped ones is the largest of (what is left) / (weight
    that is left) over all places in that order."""
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    targets = (
        stats.withColumn("weight", weight)
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("documents") / GROUP)
    return written(
        targets.select("source", "source_size", "target", rate.alias("rate"), groups.alias("groups")), "source-targets"
    )


def draw(*columns) -> Column:
    """Uniform in [0, 1), the same for the same values."""
    return F.pmod(F.xxhash64(F.lit("mixing"), *columns), F.lit(1 << 53)) / float(1 << 53)


DOCUMENT = "struct<size:bigint,doc_id:bigint,mass:double>"
DONE = "struct<doc_id:bigint,extra:int>"


def _document(like: Column, mass: Column) -> Column:
    return F.struct(like["size"].alias("size"), like["doc_id"].alias("doc_id"), mass.alias("mass"))


def _none() -> Column:
    return F.lit(None).cast(DOCUMENT)


def _settled(x: Column) -> Column:
    return (x["mass"] <= EXACT * x["size"]) | (x["mass"] >= (1 - EXACT) * x["size"])


def _verdict(x: Column) -> Column:
    return F.struct(x["doc_id"].alias("doc_id"), (x["mass"] * 2 > x["size"]).cast("int").alias("extra"))


def _state(left: Column, done: Column) -> Column:
    return F.struct(left.cast(DOCUMENT).alias("left"), done.cast(f"array<{DONE}>").alias("done"))


def _meet(state: Column, new: Column) -> Column:
    """The document left so far and a new one exchange mass until one has all or none of its own."""
    old, done = state["left"], state["done"]
    up = F.least(old["size"] - old["mass"], new["mass"])  # what the old one can take
    down = F.least(old["mass"], new["size"] - new["mass"])  # what it can give
    moved = F.when(draw(old["doc_id"], new["doc_id"]) * (up + down) < down, up).otherwise(-down)

    def after(move: Column) -> Column:
        pair = F.array(_document(old, old["mass"] + move), _document(new, new["mass"] - move))

        def keep(pair: Column) -> Column:
            return _state(
                F.get(F.filter(pair, lambda x: ~_settled(x)), F.lit(0)),
                F.concat(done, F.transform(F.filter(pair, _settled), _verdict)),
            )

        return let(pair, keep)

    return F.when(old.isNull(), _state(new, done)).otherwise(let(moved, after))


def meet_all(documents: Column) -> Column:
    """struct(left, done) for an array of documents with a fraction each."""
    start = _state(_none(), F.array())
    return F.aggregate(documents, start, _meet)


def rounded(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, doc_id, copies) of every source and id."""
    units = sizes.groupBy("source", "doc_id").agg(F.sum("size").alias("size"))
    named = targets.select(F.col("source").alias("of"), "rate", "groups")
    units = written(
        units.join(named, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("part", F.col("rate") - F.floor("rate"))
        .drop("of", "rate"),
        "mixing-units",
    )
    mass = F.col("part") * F.col("size")
    entrants = units.where("size > 0 and part > 0").select(
        "source",
        F.pmod(F.xxhash64(F.lit("group"), "doc_id"), F.col("groups")).alias("group"),
        F.struct("size", "doc_id", mass.alias("mass")).alias("document"),
        ((F.col("groups") > 1) & (draw(F.lit("waits"), "doc_id") * F.col("groups") * GROUP < WAITING)).alias("waits"),
    )
    waiting = entrants.where("waits").select("source", F.lit(0).cast("long").alias("group"), "document")
    entrants = entrants.where("not waits").drop("waits")
    most = targets.agg(F.max("groups")).first()[0] or 1
    settled = None
    while True:
        if most <= 1:
            entrants = entrants.unionByName(waiting)
        order = F.sort_array(F.collect_list("document"), asc=False)
        met = entrants.groupBy("source", "group").agg(meet_all(order).alias("met"))
        met = written(met.select("source", "group", "met.left", "met.done"), "mixing-round")
        done = met.select("source", F.inline("done"))
        settled = done if settled is None else settled.unionByName(done)
        rest = met.where(F.col("left").isNotNull())
        if most <= 1:
            break
        most = -(-most // GROUP)
        entrants = rest.select("source", F.floor(F.col("group") / GROUP).alias("group"), F.col("left").alias("document"))
    last = rest.select(
        "source",
        "left.doc_id",
        (F.col("left.mass") * 2 > F.col("left.size")).cast("int").alias("extra"),
    )
    settled = settled.unionByName(last).select(F.col("source").alias("of"), F.col("doc_id").alias("id"), "extra")
    same = F.col("source").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))
    empty = F.when(F.col("size") == 0, (draw("doc_id") < F.col("part")).cast("int")).otherwise(0)
    return units.join(settled, same, "left").select(
        "source", "doc_id", (F.col("whole") + F.coalesce("extra", empty)).cast("int").alias("copies")
    )


def mixed_sizes(documents: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per document row: doc_id, source, size, source_size, target, copies, taken = copies * size."""
    sizes = document_sizes(documents)
    targets = source_targets(sizes, weights, share, most)
    copies = rounded(sizes, targets).select(F.col("source").alias("of"), F.col("doc_id").alias("id"), "copies")
    named = targets.select(F.col("source").alias("from"), "source_size", "target")
    same = F.col("source").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))
    return (
        sizes.join(copies, same)
        .join(named, F.col("source").eqNullSafe(F.col("from")))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
    )


def mix(documents: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    sizes = document_sizes(documents)
    copies = rounded(sizes, source_targets(sizes, weights, share, most))
    unit = F.xxhash64("source", "doc_id")
    taken = copies.where("copies > 0").select(
        unit.alias("__tw_unit"),
        F.col("source").alias("__tw_source"),
        F.col("doc_id").alias("__tw_id"),
        F.col("copies").alias("__tw_copies"),
    )

    def equal(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) == F.col(b), F.col(a).isNull() & F.col(b).isNull())

    joined = documents.withColumn("__tw_key", unit).join(
        taken, (F.col("__tw_key") == F.col("__tw_unit")) & equal("source", "__tw_source") & equal("doc_id", "__tw_id")
    )
    repeated = joined.withColumn("__tw_copy", F.explode(F.sequence(F.lit(1), F.col("__tw_copies"))))
    return repeated.select(*documents.columns)
