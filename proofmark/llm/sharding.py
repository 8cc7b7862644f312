"""Placement of keys on shards by a permutation-filled look-up table."""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import col

#: A prime much larger than the number of shards: the size of the table, and so of the broadcast.
SLOTS = 10_007


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard of every slot.

    Each shard prefers the slots in an order of its own, offset + k * skip modulo the prime number of slots, from two hashes of
    its name. Shards take turns, each claiming the first slot in its order that is free, until none is: shares differ by one slot
    at most, and a shard that comes or goes moves few keys besides its own.
    """
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, and not more of them than slots")
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    place = [xxhash.xxh64_intdigest(s, 1) % slots for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            table[place[k]] = k
            left -= 1
            if not left:
                break
    return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 32 bits of the MD5 of its text, modulo the slots. A null key hashes as the empty text."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(slots))


def place(df: DataFrame, shards: list[str], id_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """One row per input row: id, slot, shard. The table, of a fixed number of rows, is broadcast; nothing is shuffled.

    Null ids go where the empty text goes; repeated rows go together; an empty table gives none.
    """
    table = lookup_table(shards, slots)
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], "slot long, shard string")
    return df.select(col(id_col).alias(id_col), slot(col(id_col), slots).alias("slot")).join(F.broadcast(listed), "slot").select(id_col, "slot", "shard")
