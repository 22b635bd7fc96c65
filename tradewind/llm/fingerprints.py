"""Document fingerprints that tell how two versions differ: invertible Bloom lookup sketches of paragraphs.

A document is the set of its paragraphs (lines), each with the number of times
it occurs; a 64-bit digest stands for each. A sketch is three rows of cells, and
every digest goes to one cell of each row. A cell keeps the number of its
digests, and their exclusive or, and that of their checks. Subtracting two
sketches cell by cell leaves the digests that only one version has. Peeling finds
a cell with a single digest, takes that digest out of its other cells, and goes
on; when all cells end empty, the difference is known. If they don't, the
comparison is repeated with larger rows and other cells.

Long documents have one sketch for about every PARAGRAPHS paragraphs, dealt by
digest, so the work grows with the text and not with its square. The fingerprint
itself is the sketch of the smallest size over all paragraphs, written out.

Null texts are empty; an empty text is one empty paragraph. The likeness of two
documents is the share of common paragraphs among all of theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.shared import ROW_KEY, keyed, let, written

#: Paragraphs that a sketch of the first size should hold, and the cells of its rows by attempt.
PARAGRAPHS = 8
SIZES = (4, 8, 16, 32, 64)
ROWS = 3
#: Rounds of peeling: as many as a difference of this size can need.
ROUNDS = 12

EMPTY = "array<bigint>"


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def _places(digest: Column, size: int) -> Column:
    """The cells of a digest, one in each row."""
    return F.array(*(F.pmod(F.xxhash64(digest, F.lit(size), F.lit(row)), F.lit(size)) + row * size for row in range(ROWS)))


def _cell(n: Column, key: Column, checks: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), key.alias("key"), checks.alias("check"))


def sketch(digests: Column, size: int) -> Column:
    """The cells of an array of distinct digests: array of struct(n, key, check)."""
    placed = F.transform(digests, lambda x: F.struct(x.alias("key"), check(x).alias("check"), _places(x, size).alias("at")))

    def cells(placed: Column) -> Column:
        def cell(c: Column) -> Column:
            own = F.filter(placed, lambda x: F.array_contains(x["at"], c))
            return let(own, lambda o: _cell(F.size(o), _xor(o["key"]), _xor(o["check"])))

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(ROWS * size - 1).cast("long")), cell)

    return let(placed, cells)


def subtract(a: Column, b: Column) -> Column:
    return _combined(a, b, lambda x, y: x - y)


def add(a: Column, b: Column) -> Column:
    return _combined(a, b, lambda x, y: x + y)


def _combined(a: Column, b: Column, numbers: Callable[[Column, Column], Column]) -> Column:
    def cell(x: Column, y: Column) -> Column:
        return _cell(numbers(x["n"], y["n"]), x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"]))

    return F.zip_with(a, b, cell)


def peel(cells: Column, size: int) -> Column:
    """struct(only_a, only_b): the digests of a difference; null if some stay entangled."""

    def state(cells: Column, a: Column, b: Column) -> Column:
        return F.struct(cells.alias("cells"), a.cast(EMPTY).alias("only_a"), b.cast(EMPTY).alias("only_b"))

    def step(now: Column, _: Column) -> Column:
        single = F.filter(now["cells"], lambda c: (F.abs(c["n"]) == 1) & (check(c["key"]) == c["check"]))
        found = F.array_distinct(F.transform(single, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))

        def place(x: Column) -> Column:
            key = x["key"]
            return F.struct(x["n"].alias("n"), key.alias("key"), check(key).alias("check"), _places(key, size).alias("at"))

        placed = F.transform(found, place)

        def without(placed: Column) -> Column:
            def cell(c: Column, at: Column) -> Column:
                own = F.filter(placed, lambda x: F.array_contains(x["at"], at.cast("long")))
                total = F.aggregate(own, F.lit(0).cast("long"), lambda n, x: n + x["n"])
                return F.when(F.size(own) == 0, c).otherwise(
                    _cell(c["n"] - total, c["key"].bitwiseXOR(_xor(own["key"])), c["check"].bitwiseXOR(_xor(own["check"])))
                )

            def keys(sign: int) -> Column:
                return F.filter(placed, lambda x: x["n"] == sign)["key"]

            return F.when(F.size(placed) == 0, now).otherwise(
                state(F.transform(now["cells"], cell), F.concat(now["only_a"], keys(1)), F.concat(now["only_b"], keys(-1)))
            )

        return let(placed, without)

    def finish(now: Column) -> Column:
        left = F.exists(now["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0))
        return F.when(~left, F.struct(now["only_a"].alias("only_a"), now["only_b"].alias("only_b")))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, state(cells, F.array(), F.array()), step, finish)


def difference(a: Column, b: Column) -> Column:
    """struct(only_a, only_b) of two arrays of distinct digests, by sketches of growing size.

    A pair that no size untangles is compared digest by digest."""
    attempts = [peel(subtract(sketch(a, size), sketch(b, size)), size) for size in SIZES]
    return F.coalesce(*attempts, F.struct(F.array_except(a, b).alias("only_a"), F.array_except(b, a).alias("only_b")))


def paragraphs(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x))


def following(documents: DataFrame) -> DataFrame:
    """(id, key, copies, next_id, next_key): the distinct documents and the one after each, by falling id, around the end.

    Ids are range-partitioned; each partition finds its own successors, and the
    first document of the next partition stands behind its last one. Ids that
    repeat with other texts stand by row key, null ids last."""
    rows = documents.groupBy("doc_id", ROW_KEY).agg(F.count("*").alias("copies"))
    order = (F.col("doc_id").desc_nulls_last(), F.col(ROW_KEY))
    ranged = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "document-order")
    me = F.struct("doc_id", ROW_KEY)
    within = Window.partitionBy("part").orderBy(*order)
    first = F.when(F.row_number().over(within) == 1, me)
    local = ranged.withColumn("next", F.lead(me).over(within)).withColumn("first", first)
    # One row per partition.
    heads = local.where(F.col("first").isNotNull()).select("part", "first")
    every = Window.partitionBy().orderBy("part")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("first").over(every), F.first("first").over(whole))
    heads = heads.select(F.col("part").alias("head_of"), after.alias("after"))
    following = local.join(heads, F.col("part") == F.col("head_of")).withColumn("next", F.coalesce("next", "after"))
    return written(
        following.select(
            F.col("doc_id").alias("id"),
            F.col(ROW_KEY).alias("key"),
            "copies",
            F.col("next.doc_id").alias("next_id"),
            F.col(f"next.{ROW_KEY}").alias("next_key"),
        ),
        "document-successors",
    )


def _same(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) == F.col(b), F.col(a).isNull() & F.col(b).isNull())


def versions(documents: DataFrame) -> DataFrame:
    """Per document row its text, edited text and next text's paragraphs: key, doc_id, copy, n_chars, edited_sha256, and
    the arrays own, edited, next.

    Of rows with the same id and text, each but the last is followed by its like."""
    rows = keyed(documents).withColumn("text", F.coalesce("text", F.lit("")))
    successors = following(rows)
    half = F.floor(F.length("text") / 2).cast("int")

    order = Window.partitionBy(ROW_KEY, "doc_id").orderBy(F.lit(0))
    placed = (
        rows.join(successors, (F.col(ROW_KEY) == F.col("key")) & _same("doc_id", "id"))
        .withColumn("copy", F.row_number().over(order))
        .select("key", "doc_id", "copy", "copies", "next_id", "next_key", "text")
    )
    # What a text hands to the one before it: its beginning, of the length that one needs, and its paragraphs.
    lengths = placed.where("copy = 1").select(F.col("next_key").alias("of_key"), F.col("next_id").alias("of_id"),
                                              F.col("key").alias("to_key"), F.col("doc_id").alias("to_id"), half.alias("need"))
    handed = (
        placed.where("copy = 1")
        .select("key", "doc_id", "text")
        .join(lengths, (F.col("key") == F.col("of_key")) & _same("doc_id", "of_id"))
        .select("to_key", "to_id", F.left("text", "need").alias("beginning"), paragraphs(F.col("text")).alias("next"))
    )
    both = placed.join(handed, (F.col("key") == F.col("to_key")) & _same("doc_id", "to_id"))
    last = F.col("copy") == F.col("copies")
    beginning = F.when(last, F.col("beginning")).otherwise(F.left("text", half))
    edited = F.concat(F.left("text", F.length("text") - half), beginning)
    own = paragraphs(F.col("text"))
    return both.withColumn("edited_text", edited).select(
        "key",
        "doc_id",
        "copy",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        own.alias("own"),
        paragraphs(F.col("edited_text")).alias("edited"),
        F.when(last, F.col("next")).otherwise(own).alias("next"),
    )


def written_out(cells: Column) -> Column:
    text = F.transform(cells, lambda c: F.concat_ws(".", *(F.hex(c[x]) for x in ("n", "key", "check"))))
    return F.array_join(text, "-")


def likeness(n: Column, only_a: Column, only_b: Column) -> Column:
    return (n - only_a) / (n + only_b)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = versions(documents)
    name = ["key", "doc_id", "copy", "n_chars", "edited_sha256"]
    tables = F.ceil(F.greatest(F.size("own"), F.size("edited"), F.size("next")) / PARAGRAPHS)
    names = "own", "edited", "next"
    sides = F.array(*(F.struct(F.lit(k).alias("side"), F.col(c).alias("digests")) for k, c in enumerate(names)))
    # From here on all is grouped by the key that the texts are already dealt by.
    lines = texts.select(*name, tables.alias("tables"), F.explode(sides).alias("of")).select(
        *name, "tables", "of.side", F.explode("of.digests").alias("line")
    )
    counted = lines.groupBy(*name, "tables", "side", "line").agg(F.count("*").alias("n"))
    digests = counted.select(*name, "tables", "side", F.xxhash64("line", "n").alias("digest"))

    def side(k: int) -> Column:
        return F.collect_list(F.when(F.col("side") == k, F.col("digest")))

    grouped = digests.groupBy(*name, F.pmod("digest", "tables").alias("table")).agg(
        side(0).alias("own"), side(1).alias("edited"), side(2).alias("next")
    )
    compared = grouped.select(
        *name,
        F.size("own").alias("n"),
        sketch(F.col("own"), SIZES[0]).alias("own_cells"),
        sketch(F.col("edited"), SIZES[0]).alias("edited_cells"),
        difference(F.col("own"), F.col("edited")).alias("to_edited"),
        difference(F.col("own"), F.col("next")).alias("to_next"),
    )
    zero = F.lit(0).cast("long")
    none = F.transform(F.sequence(F.lit(1), F.lit(ROWS * SIZES[0])), lambda _: _cell(zero, zero, zero))

    def whole(cells: str) -> Column:
        return written_out(F.aggregate(F.collect_list(cells), none, add))

    def total(difference: str, only: str) -> Column:
        return F.sum(F.size(F.col(difference)[only]))

    sums = compared.groupBy(*name).agg(
        whole("own_cells").alias("fingerprint"),
        whole("edited_cells").alias("edited_fingerprint"),
        F.sum("n").alias("n"),
        *(total(d, o).alias(f"{d}_{o}") for d in ("to_edited", "to_next") for o in ("only_a", "only_b")),
    )
    return sums.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("n"), F.col("to_edited_only_a"), F.col("to_edited_only_b")).alias("near_edited"),
        likeness(F.col("n"), F.col("to_next_only_a"), F.col("to_next_only_b")).alias("near_next"),
    )
