"""Acceptance reports over the layered tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions.columns import OPEN_END
from tellerflow.operators.history import DIMENSIONS, ordered_ranges, overlap_count

col, lit = F.col, F.lit
SCD2_CHECKS = ["multiple_current_rows", "duplicate_surrogate_key", "invalid_effective_range", "overlapping_versions"]


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def verdict(violations: Column) -> Column:
    return F.when(violations == 0, "PASS").otherwise("FAIL")


def named_counts(counts: dict[str, DataFrame], name: str = "check_name") -> DataFrame:
    """Stack one-row frames with a ``violations`` column under their names, with PASS or FAIL."""
    rows = stack([df.select(lit(n).alias(name), col("violations").cast("long")) for n, df in counts.items()])
    return rows.withColumn("status", verdict(col("violations")))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count().agg(F.count_if(col("count") > 1).alias("violations"))


def violating(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("violations"))


def population(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, customers and processing dates of serving tables."""
    return stack(
        [
            df.agg(F.count("*").alias("row_count"), F.countDistinct("customer_id").alias("customer_count"),
                   F.min("cob_dt").alias("min_cob_dt"), F.max("cob_dt").alias("max_cob_dt")).withColumn("table_name", lit(name))
            for name, df in tables.items()
        ]
    )


def scd2_counts(history: DataFrame, entity: str) -> DataFrame:
    """The four history rules of one dimension as columns of one row."""
    spec = DIMENSIONS[entity]
    current, start, stop = col("is_current"), col("effective_from"), col("effective_to")
    nulls = reduce(lambda a, b: a | b, [col(c).isNull() for c in (*spec.keys, *spec.metadata)])
    wrong = nulls | (start > stop) | ((current == 1) & (stop != lit(OPEN_END))) | ((current == 0) & (stop == lit(OPEN_END)))
    per_key = history.groupBy(*spec.keys).agg(F.count_if(current == 1).alias("n"), F.count_if(wrong).alias("bad"))
    rows = per_key.agg(
        F.count_if(col("n") > 1).alias("multiple_current_rows"), F.coalesce(F.sum("bad"), lit(0)).alias("invalid_effective_range")
    )
    doubles = history.groupBy(spec.sk).count().agg(F.count_if(col("count") > 1))
    overlaps = ordered_ranges(history, spec).agg(overlap_count())
    return rows.withColumns(
        {"duplicate_surrogate_key": doubles.scalar(), "overlapping_versions": overlaps.scalar(), "table_name": lit(spec.name)}
    )


def scd2_grid(dims: dict[str, DataFrame]) -> DataFrame:
    """Dimensions by checks, zero rows included: counts are unpivoted, so nothing has to be cross joined."""
    counts = stack([scd2_counts(df, entity) for entity, df in dims.items()])
    grid = counts.unpivot(["table_name"], SCD2_CHECKS, "check_name", "violation_count")
    return grid.withColumn("status", verdict(col("violation_count"))).orderBy("table_name", "check_name")


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], pairs: dict[str, str], name: str) -> DataFrame:
    """Rows of ``actual`` whose values differ from ``expected``; a missing expected value counts as its default."""
    wanted = expected.select(*keys, *[col(e).alias(f"_{e}") for e in pairs.values()])
    differs = reduce(lambda a, b: a | b, [~col(a).eqNullSafe(col(f"_{e}")) for a, e in pairs.items()])
    rows = actual.join(wanted, keys, "left").agg(F.count_if(differs).alias(name))
    return rows.withColumn("status", verdict(col(name)))


def on_dates(df: DataFrame, dates: list[dt.date], start: Column, stop: Column) -> DataFrame:
    """Repeat each row for the report dates inside [start, stop]; an array filter, not a join."""
    inside = F.filter(F.array(*[lit(d) for d in dates]), lambda d: d.between(start, stop))
    return df.withColumn("cob_dt", F.explode(inside))


def latest_status(log: DataFrame) -> DataFrame:
    """The last event of each job, date and pipeline run; an older success never hides a newer failure."""
    last = F.max_by(F.struct("status", "dag_run_id", "try_number"), "id").alias("last")
    return log.groupBy("job_name", "cob_dt", "pipeline_run_id").agg(last).select("job_name", "cob_dt", "pipeline_run_id", "last.*")


def run_flags(expected: DataFrame, log: DataFrame, day: dt.date, run_id: str) -> DataFrame:
    """Expected jobs against the latest status of one run; unexpected jobs and missing ones both fail."""
    latest = latest_status(log.where((col("cob_dt") == lit(day)) & (col("pipeline_run_id") == run_id))).select("job_name", "status")
    both = expected.select("job_name", lit(True).alias("wanted")).join(latest, "job_name", "full_outer")
    good = F.coalesce(col("wanted"), lit(False)) & (F.coalesce(col("status"), lit("")) == "S")
    return both.select("job_name", "status", F.when(good, "PASS").otherwise("FAIL").alias("result"))


def dq_summary(results: DataFrame) -> DataFrame:
    """Counts of the latest data-quality run."""
    last = results.groupBy("dq_run_id").agg(F.max("executed_at").alias("at")).agg(F.max_by("dq_run_id", "at")).scalar()
    rows, failed = results.where(col("dq_run_id") == last), ~col("passed")
    return rows.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.count_if(failed).alias("failed"),
        F.count_if(failed & (col("severity") == "critical")).alias("critical_failed"),
        F.count_if(failed & (col("severity") == "warning")).alias("warning_failed"),
    )
