"""Scans of layered tables and the three ways a feed is stamped with its processing date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerflow.functions.columns import day_lit


def full_snapshot(df: DataFrame, day: dt.date) -> DataFrame:
    """The whole source table, stamped with one processing date."""
    return df.withColumn("cob_dt", day_lit(day))


def incremental_day(df: DataFrame, event: str, day: dt.date) -> DataFrame:
    """Only the events of one day. The filter is on the raw timestamp, so the scan can push it down."""
    start = F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
    stop = F.lit(dt.datetime.combine(day + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz")
    return df.where((F.col(event) >= start) & (F.col(event) < stop)).withColumn("cob_dt", day_lit(day))


def initial_history(df: DataFrame, event: str) -> DataFrame:
    """The whole event history; each row carries the processing date of its own day."""
    return df.withColumn("cob_dt", F.col(event).cast("date"))


def snapshot_partition(df: DataFrame, day: dt.date) -> DataFrame:
    """Exactly one processing-date partition."""
    return df.where(F.col("cob_dt") == day_lit(day))


def asof_dimension(history: DataFrame, day: dt.date) -> DataFrame:
    """The versions valid on a day."""
    return history.where(day_lit(day).between(F.col("effective_from"), F.col("effective_to")))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a layered table. With a declared schema, columns an older file lacks come back as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], **values: object) -> DataFrame:
    """A job's SQL with typed parameter markers (``:cob_dt``) over named frames.

    Values are bound, never spliced into the text; an unbound marker is an
    analysis error. Tables are named in the text as ``{name}``.
    """
    return spark.sql(text, args=dict(values), **dict(tables))
