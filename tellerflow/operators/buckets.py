"""Stored tables of keyed rows that a day changes in a few places: only the changed buckets of keys are written again.

A row's bucket is a hash of its key. Open versions of a history, and the rows of a
current-state table, are partitioned by it; versions closed on one day stay one
partition. A bucket has changed if the row count or two order-free sums of row
hashes differ before and after, which takes one aggregate of BUCKETS rows for
each side; then the plan runs again over the changed buckets alone, and only
those are read, staged and replaced.

A run that stopped between two partitions leaves a mixture; its rows differ from
what the next run finds, so that run writes these buckets again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.functions.columns import OPEN_END
from tellerflow.operators import history as H
from tellerflow.operators import sinks

KEY_BUCKET = "key_bucket"
BUCKETS = 64


def key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _prints(rows: DataFrame, keys: Sequence[str]) -> dict[int, tuple]:
    value = F.xxhash64(*sorted(rows.columns))
    found = rows.groupBy(key_bucket(keys).alias("b")).agg(F.count("*"), F.bit_xor(value), F.sum(value.cast("decimal(38,0)")))
    return {r[0]: tuple(r)[1:] for r in found.collect()}  # a row per bucket


def changed_buckets(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> list[int]:
    old, new = _prints(before, keys), _prints(after, keys)
    return sorted(b for b in {*old, *new} if old.get(b) != new.get(b))


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions with their bucket; closed ones are not split."""
    return rows.withColumn(KEY_BUCKET, F.when(F.col(H.TO) == F.lit(OPEN_END), key_bucket(keys)).otherwise(F.lit(0)))


def save_history(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """First write of a history; a bucket is one file."""
    placed = _placed(rows, keys).repartition(H.TO, KEY_BUCKET)
    sinks.overwrite_partitions(placed, path, [H.TO, KEY_BUCKET])


def save_history_day(path: str, snapshot: DataFrame, spec: H.Dimension, day: dt.date, check: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[int]:
    """Apply a day's snapshot to a stored history; gives the buckets that were written.

    Versions closed by the day are written before the open ones: if the run stops
    in between, they exist twice and recovery keeps the open copy.
    """
    spark, keys, yesterday = snapshot.sparkSession, spec.keys, F.lit(day - dt.timedelta(days=1))
    stored = H.day_slice(spark.read.parquet(path), day)
    plain = stored.drop(KEY_BUCKET)
    touched = changed_buckets(plain, check(H.apply_snapshot(plain, snapshot, spec, day)), keys)
    if not touched:
        return []
    own, is_open = key_bucket(keys).isin(touched), F.col(H.TO) == F.lit(OPEN_END)
    part = stored.where((is_open & F.col(KEY_BUCKET).isin(touched)) | ((F.col(H.TO) == yesterday) & own)).drop(KEY_BUCKET)
    rest = stored.where((F.col(H.TO) == yesterday) & ~own).drop(KEY_BUCKET)
    after = check(H.apply_snapshot(part, snapshot.where(own), spec, day)).unionByName(rest)
    staged = sinks.durable(_placed(after, keys).repartition(H.TO, KEY_BUCKET), "history-stage")
    for kept in (~is_open, is_open):
        sinks.overwrite_partitions(staged.where(kept), path, [H.TO, KEY_BUCKET])
    # A dynamic overwrite leaves a partition alone when nothing is written to it.
    written = {(r[0], r[1]) for r in staged.select(H.TO, KEY_BUCKET).distinct().collect()}
    for to, bucket in [(day - dt.timedelta(days=1), 0), *[(OPEN_END, b) for b in touched]]:
        if (to, bucket) not in written:
            sinks.remove(spark, f"{path}/{H.TO}={to.isoformat()}/{KEY_BUCKET}={bucket}")
    return touched


def save_current(path: str, snapshot: DataFrame, keys: Sequence[str], check: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[int]:
    """Upsert a snapshot into a stored current-state table; gives the buckets that were written."""
    spark = snapshot.sparkSession
    place = lambda rows: rows.withColumn(KEY_BUCKET, key_bucket(keys)).repartition(KEY_BUCKET)
    if not sinks.exists(spark, path):
        H.guard_keys(snapshot, list(keys), "current-state table")
        sinks.overwrite_partitions(place(check(snapshot)), path, KEY_BUCKET)
        return list(range(BUCKETS))
    stored = spark.read.parquet(path)
    plain = stored.drop(KEY_BUCKET)
    touched = changed_buckets(plain, check(H.scd1_upsert(plain, snapshot, keys)), keys)
    if touched:
        part = stored.where(F.col(KEY_BUCKET).isin(touched)).drop(KEY_BUCKET)
        after = H.scd1_upsert(part, snapshot.where(key_bucket(keys).isin(touched)), keys)
        sinks.overwrite_partitions(sinks.durable(place(check(after)), "current-stage"), path, KEY_BUCKET)
    return touched


def read(spark: SparkSession, path: str) -> DataFrame:
    """A stored table without its bucket column."""
    return spark.read.parquet(path).drop(KEY_BUCKET)
