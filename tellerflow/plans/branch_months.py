"""Branch months as a state that grows by a day: channel sums and bitmaps of active customers.

A state holds, per branch and month, one row per channel with its sums and one
row per bucket with the bitmap of its customers. States of disjoint sets of
events merge by adding sums and OR-ing bitmaps. A day's events only
touch the state of their month; the rows of other months stay as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerflow.operators.asof import from_the_beginning
from tellerflow.schemas import Table
from tellerflow.sources.files import asof_dimension

MONTH = ["branch_code", "txn_year", "txn_month"]
SUMS = ["n", "amount", "credit", "debit"]
_SUM = "decimal(38,2)"
_KEYS = "branch_code STRING, txn_year INT, txn_month INT"
_MONEY = "amount DECIMAL(38,2), credit DECIMAL(38,2), debit DECIMAL(38,2)"
STATE = Table(
    "branch_month_state", f"{_KEYS}, is_channel BOOLEAN, channel STRING, bucket BIGINT, n BIGINT, {_MONEY}, bits BINARY, cob_dt DATE",
    (*MONTH, "is_channel", "channel", "bucket", "cob_dt"), "cob_dt",
)
ROWS = Table("branch_month_rows", f"{_KEYS}, active_customers BIGINT, n BIGINT, {_MONEY}, top_channel STRING, cob_dt DATE", (*MONTH, "cob_dt"), "cob_dt")


def attributed(fact: DataFrame, accounts: DataFrame, bootstrap: bool = False, day: dt.date | None = None) -> DataFrame:
    """Events with the branch of the account version valid on their date; with ``day``, its events and versions only."""
    if day:
        fact, accounts = fact.where(F.col("cob_dt") == F.lit(day)), asof_dimension(accounts, day)
    versions = from_the_beginning(accounts, "account_id") if bootstrap else accounts
    side = versions.select(F.col("account_id").alias("_key"), "branch_code", "effective_from", "effective_to")
    event_day = F.col("txn_date").cast("date")
    valid = (F.col("account_id") == F.col("_key")) & event_day.between(F.col("effective_from"), F.col("effective_to"))
    return fact.join(side, valid).select(
        "branch_code", F.year(event_day).alias("txn_year"), F.month(event_day).alias("txn_month"), "customer_id", "channel", "txn_amount", "debit_credit"
    )


def state_of(events: DataFrame) -> DataFrame:
    """The state of attributed events, in one scan: two grouping sets, one by channel and one by bucket of customers."""
    amount, kind, who = F.col("txn_amount"), F.col("debit_credit"), F.col("customer_id")
    rows = events.select(
        *MONTH, "channel", F.bitmap_bucket_number(who).alias("bucket"), F.bitmap_bit_position(who).alias("at"), F.abs(amount).alias("amount"),
        F.when(kind == "C", amount).alias("credit"), F.when(kind == "D", amount).alias("debit"),
    )
    found = rows.groupingSets([[*MONTH, "channel"], [*MONTH, "bucket"]], *MONTH, "channel", "bucket").agg(
        (F.grouping("bucket") == 1).alias("is_channel"), F.count(F.lit(1)).alias("n"),
        *[F.sum(c).cast(_SUM).alias(c) for c in SUMS[1:]], F.bitmap_construct_agg("at").alias("bits"),
    )
    return _either(found)


def _either(rows: DataFrame) -> DataFrame:
    """Sums on channel rows only, bitmaps on the others only."""
    channel = F.col("is_channel")
    sums = [F.when(channel, F.col(c)).alias(c) for c in SUMS]
    return rows.select(*MONTH, "is_channel", "channel", "bucket", *sums, F.when(~channel, F.col("bits")).alias("bits"))


def merge(state: DataFrame, other: DataFrame) -> DataFrame:
    """The state of the events of both."""
    both = state.unionByName(other).groupBy(*MONTH, "is_channel", "channel", "bucket")
    added = both.agg(F.sum("n").alias("n"), *[F.sum(c).cast(_SUM).alias(c) for c in SUMS[1:]], F.bitmap_or_agg("bits").alias("bits"))
    return _either(added)


def month_rows(state: DataFrame) -> DataFrame:
    """One row per branch and month: distinct customers, sums, and the most used channel, ties by name."""
    channel = F.col("is_channel")
    return state.groupBy(*MONTH).agg(
        F.coalesce(F.sum(F.when(~channel, F.bitmap_count("bits"))), F.lit(0)).alias("active_customers"),
        F.sum("n").alias("n"),
        *[F.sum(c).cast(_SUM).alias(c) for c in SUMS[1:]],
        F.min_by("channel", F.when(channel, F.struct(-F.col("n"), F.col("channel")))).alias("top_channel"),
    )


def emptied(spark: SparkSession, months: list[tuple[int, int]]) -> DataFrame:
    """State rows without events, so that a month which lost all of its own does not fall back to an earlier state."""
    rows = [(None, y, m, True, None, None, 0, None, None, None, None) for y, m in months]
    return spark.createDataFrame(rows, StructType([f for f in STATE.struct if f.name != "cob_dt"]))


def latest(rows: DataFrame, day: dt.date) -> DataFrame:
    """Of stored month rows or states, each month's as of a day: those of its last processing date up to then."""
    known = rows.where(F.col("cob_dt") <= F.lit(day))
    last = known.groupBy("txn_year", "txn_month").agg(F.max("cob_dt").alias("cob_dt"))  # a row per month
    return known.join(last, ["txn_year", "txn_month", "cob_dt"]).where("coalesce(n, 1) > 0").drop("cob_dt")
