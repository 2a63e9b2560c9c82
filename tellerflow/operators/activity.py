"""Per-customer aggregates, one scan per source, shared by every mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions.columns import in_window
from tellerflow.operators import rolling
from tellerflow.operators.rolling import Measure, Rolling

LOOKBACK = 365
WINDOWS = (30, 90, 365)


def _recent(fact: DataFrame, day: dt.date, days: int) -> DataFrame:
    """Prune by partition: a fact's cob_dt is the date of its event."""
    return fact.where(in_window(F.col("cob_dt"), day, days))


def _within(day: dt.date, days: int) -> Column:
    return in_window(F.col("cob_dt"), day, days)


def account_activity(fact: DataFrame, day: dt.date) -> DataFrame:
    """Counts, amounts and last event of account transactions over 30, 90 and 365 days.

    Grouped by customer and channel first, then by customer: the most used
    channel falls out of the same scan, and a hot customer reaches the second
    step as a handful of rows.
    """
    amount, size, kind = F.col("txn_amount"), F.abs("txn_amount"), F.col("debit_credit")
    measures: list[Column] = []
    for days in WINDOWS:
        inside = _within(day, days)
        measures += [
            F.count_if(inside).alias(f"cnt_{days}"),
            F.sum(F.when(inside, size)).alias(f"amt_{days}"),
            F.max(F.when(inside, F.col("txn_date"))).alias(f"last_{days}"),
        ]
    month = _within(day, 30)
    measures += [
        F.count_if(month & (kind == "C")).alias("credit_cnt"),
        F.count_if(month & (kind == "D")).alias("debit_cnt"),
        F.sum(F.when(month & (kind == "C"), amount)).alias("credit_amt"),
        F.sum(F.when(month & (kind == "D"), size)).alias("debit_amt"),
    ]
    by_channel = _recent(fact, day, LOOKBACK).groupBy("customer_id", "channel").agg(*measures)
    return _account_totals(by_channel)


def _totals(rows: DataFrame, part: str) -> list[Column]:
    names = [c for c in rows.columns if c not in ("customer_id", part)]
    return [(F.max if name.startswith("last_") else F.sum)(name).alias(name) for name in names]


def _account_totals(by_channel: DataFrame) -> DataFrame:
    used = F.when(F.col("cnt_30") > 0, F.struct(-F.col("cnt_30"), F.col("channel")))
    return by_channel.groupBy("customer_id").agg(*_totals(by_channel, "channel"), F.min_by("channel", used).alias("primary_channel"))


def spend_rows(card_fact: DataFrame) -> DataFrame:
    """Card activity that counts: successful and not given back."""
    return card_fact.where((F.col("status") == "SUCCESS") & ~F.col("txn_type").isin("REFUND", "REVERSAL"))


def card_activity(fact: DataFrame, day: dt.date) -> DataFrame:
    """The same measures for card spend, with the 30-day average and number of merchant categories."""
    rows = spend_rows(_recent(fact, day, LOOKBACK))
    measures: list[Column] = []
    for days in WINDOWS:
        inside = _within(day, days)
        measures += [
            F.count_if(inside).alias(f"cnt_{days}"),
            F.sum(F.when(inside, F.col("txn_amount"))).alias(f"amt_{days}"),
            F.max(F.when(inside, F.col("txn_date"))).alias(f"last_{days}"),
        ]
    by_category = rows.groupBy("customer_id", "merchant_category").agg(*measures)
    return _card_totals(by_category)


def _card_totals(by_category: DataFrame) -> DataFrame:
    seen = (F.col("cnt_30") > 0) & F.col("merchant_category").isNotNull()
    return by_category.groupBy("customer_id").agg(*_totals(by_category, "merchant_category"), F.count_if(seen).alias("categories_30"))


# --- the same measures carried from day to day ---------------------------------------------------


def _account_rolling() -> Rolling:
    amount, size, kind = F.col("txn_amount"), F.abs("txn_amount"), F.col("debit_credit")
    is_c, is_d = kind == "C", kind == "D"
    return Rolling(
        ("customer_id", "channel"),
        "txn_date",
        (
            Measure("cnt", F.lit(1), WINDOWS, mark=True),
            Measure("amt", size, WINDOWS),
            Measure("credit_cnt", F.when(is_c, 1), (30,), mark=True),
            Measure("debit_cnt", F.when(is_d, 1), (30,), mark=True),
            Measure("credit_amt", F.when(is_c, amount), (30,)),
            Measure("debit_amt", F.when(is_d, size), (30,)),
        ),
    )


def _card_rolling() -> Rolling:
    measures = (Measure("cnt", F.lit(1), WINDOWS, mark=True), Measure("amt", F.col("txn_amount"), WINDOWS))
    return Rolling(("customer_id", "merchant_category"), "txn_date", measures)


@dataclass(frozen=True)
class Source:
    """A fact whose activity is kept as partials and states: which of its rows count, how, and the measures of a customer."""

    fact: str
    keys: str
    spec: Callable[[], Rolling]
    rows: Callable[[DataFrame], DataFrame]
    totals: Callable[[DataFrame], DataFrame]

    def partials(self, fact: DataFrame) -> DataFrame:
        return rolling.partials(self.rows(fact), self.spec())

    def activity(self, state: DataFrame) -> DataFrame:
        """What account_activity or card_activity gives for the state's day, from the state alone."""
        spec, out = self.spec(), []
        for m in spec.measures:
            for w in m.windows:
                name = f"{m.name}_{w}" if len(m.windows) > 1 else m.name
                number = F.col(f"n_{m.name}_{w}")
                out.append((number if m.mark else F.when(number > 0, F.col(f"s_{m.name}_{w}"))).alias(name))
        last = [F.when(F.col(f"n_cnt_{w}") > 0, F.col(rolling.LATEST)).alias(f"last_{w}") for w in WINDOWS]
        return self.totals(state.select(*spec.keys, *out, *last))


SOURCES = {
    "account": Source("txn_account", "customer_id BIGINT, channel STRING", _account_rolling, lambda fact: fact, _account_totals),
    "card": Source("card_txn", "customer_id BIGINT, merchant_category STRING", _card_rolling, spend_rows, _card_totals),
}


def crm_activity(fact: DataFrame, day: dt.date) -> DataFrame:
    return (
        _recent(fact, day, 90)
        .groupBy("customer_id")
        .agg(F.count("interaction_id").alias("interactions_90"), F.max("interaction_date").alias("last_interaction"))
    )


def open_complaints(fact: DataFrame, day: dt.date) -> DataFrame:
    """Complaints of any age not yet closed; a missing status counts as open."""
    settled = F.coalesce(F.upper("status"), F.lit("UNKNOWN")).isin("CLOSED", "RESOLVED")
    rows = fact.where((F.col("cob_dt") <= F.lit(day)) & (F.upper("category") == "COMPLAINT") & ~settled)
    return rows.groupBy("customer_id").agg(F.count("*").alias("open_complaints"))


# --- holdings: ids are unique in their table, so a plain conditional count is the distinct count ---


def account_holdings(accounts: DataFrame) -> DataFrame:
    active, kind = F.col("status") == "ACTIVE", F.col("account_type")
    return accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("accounts"),
        F.count_if(active & (kind == "CASA")).alias("casa_active"),
        F.count_if(active & (kind == "TIME_DEPOSIT")).alias("td_active"),
        F.sum(F.when(active, F.col("balance"))).alias("balance_sum"),
        F.avg(F.when(active, F.col("balance"))).alias("balance_avg"),
    )


def deposit_holdings(deposits: DataFrame) -> DataFrame:
    active = F.col("status") == "ACTIVE"
    return deposits.groupBy("customer_id").agg(
        F.count("deposit_id").alias("deposits"),
        F.count_if(active).alias("deposits_active"),
        F.sum(F.when(active, F.col("principal_amount"))).alias("principal_sum"),
    )


def loan_holdings(loans: DataFrame) -> DataFrame:
    active = F.col("loan_status") == "ACTIVE"
    return loans.groupBy("customer_id").agg(
        F.count("loan_id").alias("loans"),
        F.count_if(active).alias("loans_active"),
        F.sum(F.when(active, F.col("outstanding_balance"))).alias("outstanding_sum"),
    )


def card_holdings(cards: DataFrame) -> DataFrame:
    active, kind = F.col("status") == "ACTIVE", F.col("card_type")
    return cards.groupBy("customer_id").agg(
        F.count("card_id").alias("cards"),
        F.count_if(active & (kind == "CREDIT")).alias("credit_active"),
        F.count_if(active & (kind == "DEBIT")).alias("debit_active"),
        F.max(F.when(kind == "CREDIT", F.col("credit_limit"))).alias("limit_max"),
    )
