"""Exact distinct counts that can be merged: bitmaps over whole-number ids.

An id is a bit in one of the bitmaps of ``2**15`` bits that Spark's bitmap
functions number by bucket. Bitmaps of the same group and bucket merge by OR, so
days add up to months and branches to regions without the rows; a distinct
count is the sum of the buckets' set bits. A group's work is split by bucket.

Bitmaps are small where ids are dense. ``extend`` numbers other keys 1, 2, ... and
keeps the numbers that keys already have. NULL ids are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.operators.ranking import dense_ids

BUCKET, BITS = "bucket", "bits"


def extend(known: DataFrame | None, keys: DataFrame, key: str, number: str = "number") -> DataFrame:
    """(key, number) of all known keys and of the new ones among ``keys``, which get the next numbers in key order."""
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if known is None:
        return dense_ids(fresh, [key], number).select(key, number)
    largest = known.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]
    fresh = dense_ids(fresh.join(known.select(key), key, "left_anti"), [key], number)
    return known.select(key, number).unionByName(fresh.select(key, (F.col(number) + largest).alias(number)))


def bitmaps(rows: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """(groups, bucket, bits) of the ids in each group."""
    n = F.col(number)
    placed = rows.select(*groups, F.bitmap_bucket_number(n).alias(BUCKET), F.bitmap_bit_position(n).alias("_at"))
    return placed.groupBy(*groups, BUCKET).agg(F.bitmap_construct_agg("_at").alias(BITS))


def merged(maps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several sets of bitmaps put together."""
    return maps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counts(maps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """The distinct ids of each group; the bitmaps of a group and bucket are merged already."""
    return maps.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def count_distinct(rows: DataFrame, groups: Sequence[str], numbers: Mapping[str, Column]) -> DataFrame:
    """Several exact distinct counts per group in one pass; ``numbers`` names an id expression for each."""
    each = F.array(*[F.struct(F.lit(name).alias("_what"), value.cast("bigint").alias("_id")) for name, value in numbers.items()])
    long = rows.select(*groups, F.inline(each))
    maps = bitmaps(long, [*groups, "_what"], "_id")
    own = lambda name: F.when(F.col("_what") == name, F.bitmap_count(BITS))
    return maps.groupBy(*groups).agg(*[F.coalesce(F.sum(own(name)), F.lit(0)).alias(name) for name in numbers])
