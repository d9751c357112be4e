"""Placement by a permutation-filled lookup table (Maglev hashing; Eisenbud et al., 2016).

Shards take turns: each claims the free slot that comes first in its own order
of preference, until the prime-sized table is full. A key's hash modulo the size
names its slot. Shares differ by one slot at most, and without one shard few
keys of the others move.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .expressions import hash_fraction
from .storage import fresh

SHARDS, SIZE = 32, 3251
#: The table is broadcast; a larger one isn't made.
MOST_SLOTS = 100_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _fraction(value: str) -> int:
    """As ``hash_fraction``."""
    return int(hashlib.md5(value.encode()).hexdigest()[:8], 16)


def fill(shards: list[str], size: int) -> list[int]:
    """The number of the shard that claims each slot. A shard goes on in its order from the slot it has last tried, so all claims take about ``size * len(shards)`` looks at most, and mostly far fewer."""
    at = [_fraction(f"offset:{s}") % size for s in shards]
    skip = [_fraction(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while table[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % size
        table[at[i]] = i
    return table


def lookup_table(spark: SparkSession, shards: list[str], size: int = SIZE) -> DataFrame:
    """``(slot, shard)`` for each of the ``size`` slots; ``size`` a prime of at least the number of shards and at most ``MOST_SLOTS``.

    The fill is sequential and bounded, so it is done once where the query is
    made; the table is one literal of the plan.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be given, each once")
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"size must be a prime from the number of shards to {MOST_SLOTS}")
    numbers = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.array(*(F.lit(s) for s in shards))
    rows = spark.range(1).select(names.alias("names"), F.posexplode(numbers).alias("slot", "at"))
    return rows.select("slot", F.get("names", F.col("at").cast("int")).alias("shard"))


def place(rows: DataFrame, key: str | Column, table: DataFrame, size: int = SIZE) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` by the key; a null key counts as the empty text, repeated rows repeat their place.

    The table has at most ``MOST_SLOTS`` rows, so it is broadcast and a row is
    placed where it is, without a shuffle, however hot its key. Where ``rows``
    has columns of these names, the new ones get an underscore.
    """
    slot, shard, of = fresh(rows.columns, "slot", "shard", "of_slot")
    key = F.col(key) if isinstance(key, str) else key
    at = (hash_fraction(F.coalesce(key.cast("string"), F.lit(""))) % size).cast("int")
    named = table.select(F.col("slot").alias(of), F.col("shard").alias(shard))
    return rows.withColumn(slot, at).join(F.broadcast(named), F.col(slot) == F.col(of), "left").select(*(F.col(c) for c in rows.columns), slot, shard)
