"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: it starts at an offset and goes on by a step, both hashes of its name. The
shards take turns, and at each turn a shard claims the first slot of its order
that is still free, until none is. A row's key is hashed to a slot, so placing
it is one lookup in a broadcast table whose size is a parameter, not the data's.
Shards get equal parts of the slots within one turn, and when a shard comes or
goes nearly all other slots stay where they were.

Rows with equal keys share a shard. Where one key may hold a large part of all
rows, name more key columns (the text's hash, for one). Null keys are placed
like any other value; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots, a prime of more than a hundred times the shards.
SLOTS = 65_537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(names: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> list[int]:
    """The shard, by place in ``names``, of every slot. A shard of weight w has w turns in each round."""
    if not is_prime(slots) or slots < len(names) or not names or len(set(names)) < len(names):
        raise ValueError("slots must be a prime, not below the number of shards, and the shards' names distinct")
    turns = list(range(len(names))) if weights is None else [k for k, w in enumerate(weights) for _ in range(w)]
    if not turns:
        raise ValueError("one shard needs a weight above 0")
    starts, steps = [], []
    for name in names:
        digest = hashlib.sha256(name.encode()).digest()
        starts.append(int.from_bytes(digest[:8], "big") % slots)
        steps.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1)
    owner, following, free = [-1] * slots, list(starts), slots
    while free:
        for shard in turns[:free]:
            slot = following[shard]
            while owner[slot] >= 0:
                slot = (slot + steps[shard]) % slots
            owner[slot] = shard
            following[shard] = (slot + steps[shard]) % slots
        free -= len(turns[:free])
    return owner


def lookup_table(spark: SparkSession, owner: Sequence[int]) -> DataFrame:
    """(slot, shard): ``slots`` rows."""
    listed = F.split(F.lit(",".join(map(str, owner))), ",")
    table = spark.range(1).select(F.posexplode(listed).alias("__tw_slot", "__tw_shard"))
    return table.select("__tw_slot", F.col("__tw_shard").cast("int").alias("__tw_shard"))


def place(rows: DataFrame, names: Sequence[str], key: Sequence[str] = ("doc_id",), slots: int = SLOTS) -> DataFrame:
    """``rows`` with their slot and shard (a place in ``names``) as columns slot and shard, replacing any so named."""
    table = F.broadcast(lookup_table(rows.sparkSession, fill(names, slots)))
    slot = F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")
    kept = [c for c in rows.columns if c not in ("slot", "shard")]
    placed = rows.withColumn("__tw_at", slot).join(table, F.col("__tw_at") == F.col("__tw_slot"))
    return placed.select(*kept, F.col("__tw_slot").alias("slot"), F.col("__tw_shard").alias("shard"))


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]
