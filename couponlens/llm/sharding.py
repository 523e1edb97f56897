"""Shard placement by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table, an
offset and a stride hashed from its name. Shards take turns claiming their
next free slot until the table is full, so every shard holds an almost equal
number of slots, and when a shard leaves, the slots of the others hardly
move. A key's slot is its hash modulo the table size; the table, whose size
is a parameter and does not depend on the data, is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """(offset, stride) of a shard's permutation of the slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, float] | None = None) -> list[int]:
    """Slot -> place in ``shards``. A shard of weight w takes w / max(w) of the turns; shards of weight 0 take none."""
    if not _is_prime(slots):
        raise ValueError(f"the table size must be a prime, not {slots}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be named, distinct and no more than slots")
    share = [float((weights or {}).get(s, 1.0)) for s in shards]
    if min(share) < 0 or max(share) <= 0:
        raise ValueError("weights must not be negative, and one must be above zero")
    share = [w / max(share) for w in share]
    orders = [preference(s, slots) for s in shards]
    table, turns, credit, claimed = [-1] * slots, [0] * len(shards), [0.0] * len(shards), 0
    while True:
        for i, (offset, stride) in enumerate(orders):
            credit[i] += share[i]
            if credit[i] < 1:
                continue
            credit[i] -= 1
            while True:
                slot = (offset + turns[i] * stride) % slots
                turns[i] += 1
                if table[slot] < 0:
                    break
            table[slot] = i
            claimed += 1
            if claimed == slots:
                return table


def shard_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(slot, shard), one row per slot."""
    table = lookup_table(shards, slots, weights)
    return spark.createDataFrame([(slot, shards[i]) for slot, i in enumerate(table)], "slot int, shard string")


def assign(rows: DataFrame, key_cols: Sequence[str], table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``__slot`` and ``__shard``, which depend on the key columns' values alone.

    Null key values hash like a value of their own. Rows of one key share a
    shard; to spread a hot key, name further columns in the key. Repeated
    rows stay; nothing is shuffled. An empty table stays empty. Columns that
    have the two names already are replaced.
    """
    key = F.concat_ws("\x1f", *[F.concat_ws("", F.col(c).isNull().cast("string"), F.col(c).cast("string")) for c in key_cols])
    keyed = rows.withColumn("__slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")).drop("__shard")
    names = table.select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    return keyed.join(F.broadcast(names), "__slot", "left")
