"""Telling rows whose key may be in a table from those whose key can't, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import fresh

BUCKETS, BUCKET_BITS = 4096, 32768


def _slot(key: Column) -> tuple[Column, Column]:
    """Bucket and bit of a key in the bitmaps."""
    at = F.pmod(F.xxhash64(key), F.lit(BUCKETS * BUCKET_BITS))
    return F.floor(at / BUCKET_BITS).cast("int"), at % BUCKET_BITS


def marked(rows: DataFrame, keys: DataFrame, key: Column | None = None, keys_key: Column | None = None) -> tuple[DataFrame, str]:
    """``rows`` with a boolean, and its name: false where ``key`` certainly isn't among ``keys``, true where it is or, by chance, might be.

    The keys go out as bitmaps of 4 KB, ``BUCKETS`` at most, so what is
    broadcast is bounded however many keys there are; as they fill up, more
    rows are marked, which the exact join to come then tells apart. A null key
    is a key like any other.
    """
    at, bit, own, maps_at, there = fresh(rows.columns, "own_bucket", "own_bit", "bitmap", "bucket", "maybe")
    bucket, slot = _slot(F.col("key") if keys_key is None else keys_key)
    maps = keys.groupBy(bucket.alias(maps_at)).agg(F.bitmap_construct_agg(slot).alias(own))
    bucket, slot = _slot(F.col("key") if key is None else key)
    with_slots = rows.withColumn(at, bucket).withColumn(bit, slot)
    found = with_slots.join(F.broadcast(maps), F.col(at) == F.col(maps_at), "left")
    byte = F.conv(F.hex(F.substring(F.col(own), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", byte, (F.col(bit) % 8).cast("int")).bitwiseAND(1) == 1
    return found.withColumn(there, F.coalesce(held, F.lit(False))).select(*(F.col(c) for c in rows.columns), there), there


def maybe(rows: DataFrame, keys: DataFrame, key: Column | None = None, keys_key: Column | None = None) -> DataFrame:
    """The ``rows`` whose key is among ``keys``, and by chance a few more."""
    out, there = marked(rows, keys, key, keys_key)
    return out.where(F.col(there)).drop(there)


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """As ``maybe`` for a column of both that is never null, where rows are very many: the bitmaps go out as arrays of longs, whose bits are told without strings."""
    at, bit, maps_at, held = fresh(rows.columns, "own_bucket", "own_bit", "bucket", "longs")
    bucket, slot = _slot(F.col(key))
    maps = keys.groupBy(bucket.alias(maps_at)).agg(F.bitmap_construct_agg(slot).alias(held))
    longs = F.transform(F.sequence(F.lit(0), F.lit(BUCKET_BITS // 64 - 1)), lambda k: F.conv(F.hex(F.call_function("substring", F.col(held), k * 8 + 1, F.lit(8))), 16, -10).cast("long"))
    both = rows.withColumn(at, bucket).withColumn(bit, slot).join(F.broadcast(maps.select(maps_at, longs.alias(held))), F.col(at) == F.col(maps_at))
    place = (F.lit(7) - F.floor(F.col(bit) / 8) % 8) * 8 + F.col(bit) % 8  # the first byte is a long's highest
    one = F.call_function("shiftright", F.get(held, F.floor(F.col(bit) / 64).cast("int")), place.cast("int")).bitwiseAND(1) == 1
    return both.where(one).select(*rows.columns)
