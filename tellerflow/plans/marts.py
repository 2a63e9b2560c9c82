"""Customer marts. Each is a function of the silver frames and the processing date.

Every 1:N source is aggregated to one row per customer before it meets the
customer spine, so no join fans out and all inputs share one hash key.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions import columns as C
from tellerflow.operators import activity as A
from tellerflow.operators.ranking import ntile_cuts, tile_of
from tellerflow.operators.sinks import durable
from tellerflow.plans import branch_months as B
from tellerflow.sources.files import asof_dimension

KEY = "customer_id"
ID = [KEY, "customer_sk"]


@dataclass(frozen=True)
class Silver:
    """Dimensions and facts the marts read."""

    dim_customer: DataFrame
    dim_account: DataFrame
    dim_branch: DataFrame
    dim_deposit: DataFrame
    dim_loan: DataFrame
    dim_card: DataFrame
    fact_txn_account: DataFrame
    fact_card_txn: DataFrame
    fact_crm_interaction: DataFrame
    states: Callable[[str, dt.date], DataFrame | None] | None = field(default=None, repr=False, compare=False)
    months: Callable[[dt.date], DataFrame | None] | None = field(default=None, repr=False, compare=False)
    _shared: dict = field(default_factory=dict, repr=False, compare=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)
    _locks: dict = field(default_factory=dict, repr=False, compare=False)

    def activity(self, source: str, day: dt.date) -> DataFrame:
        """Per-customer activity up to a day, aggregated once and written out for every mart of that day.

        It comes from the rolling state of the day where ``states`` has one; otherwise from a scan of a year of events.
        """

        def build() -> DataFrame:
            state = self.states(source, day) if self.states else None
            if state is not None:
                return A.SOURCES[source].activity(state)
            return A.account_activity(self.fact_txn_account, day) if source == "account" else A.card_activity(self.fact_card_txn, day)

        return self._once((source, day), build, f"activity-{source}")

    def holdings(self, source: str, day: dt.date) -> DataFrame:
        """Per-customer holdings of accounts, deposits, loans or cards as of a day, aggregated once for every mart of that day."""
        build = {
            "account": lambda: A.account_holdings(asof_dimension(self.dim_account, day)),
            "deposit": lambda: A.deposit_holdings(self.dim_deposit),
            "loan": lambda: A.loan_holdings(self.dim_loan),
            "card": lambda: A.card_holdings(self.dim_card),
        }[source]
        return self._once(("holdings", source, day if source == "account" else None), build, f"holdings-{source}")

    def _once(self, key: tuple, build: Callable[[], DataFrame], label: str) -> DataFrame:
        with self._lock:
            own = self._locks.setdefault(key, threading.Lock())
        with own:  # other aggregates are built meanwhile
            if key not in self._shared:
                self._shared[key] = durable(build(), label)
            return self._shared[key]


def star(spine: DataFrame, *inputs: DataFrame) -> DataFrame:
    """Left join per-customer aggregates onto the spine."""
    for rows in inputs:
        spine = spine.join(rows, KEY, "left")
    return spine


def _n(name: str, kind: str = "int") -> Column:
    """A count that is zero where the customer has no row."""
    return F.coalesce(F.col(name), F.lit(0)).cast(kind)


def _latest(a: Column, b: Column) -> Column:
    never = C.ts_lit(C.NEVER_TS)
    return F.greatest(F.coalesce(a, never), F.coalesce(b, never))


def _stamp(day: dt.date) -> Column:
    return F.lit(day).alias("cob_dt")


def _activity(s: Silver, day: dt.date) -> tuple[DataFrame, DataFrame]:
    """Account and card activity with prefixed measure names."""
    account, card = s.activity("account", day), s.activity("card", day)
    prefix = lambda rows, p: rows.select(KEY, *[F.col(c).alias(f"{p}_{c}") for c in rows.columns if c != KEY])
    return prefix(account, "a"), prefix(card, "c")


def _both(measure: str) -> Column:
    return F.coalesce(F.col(f"a_{measure}"), F.lit(0)) + F.coalesce(F.col(f"c_{measure}"), F.lit(0))


def balance_summary(s: Silver, day: dt.date) -> DataFrame:
    rows = star(
        asof_dimension(s.dim_customer, day).select(*ID),
        s.holdings("account", day),
        s.holdings("deposit", day),
        s.holdings("loan", day),
    ).withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("balance_sum", "principal_sum", "outstanding_sum")})
    aum = F.col("balance_sum") + F.col("principal_sum")
    return rows.select(
        *ID,
        C.money(F.col("balance_sum")).alias("total_account_balance"),
        C.money(F.col("balance_avg")).alias("avg_account_balance"),
        C.money(F.col("principal_sum")).alias("total_deposit_principal"),
        C.money(F.col("outstanding_sum")).alias("total_loan_outstanding"),
        C.money(aum).alias("aum_total"),
        C.money(aum - F.col("outstanding_sum")).alias("net_worth"),
        _stamp(day),
    )


def product_summary(s: Silver, day: dt.date) -> DataFrame:
    rows = star(
        asof_dimension(s.dim_customer, day).select(*ID),
        s.holdings("account", day),
        s.holdings("deposit", day),
        s.holdings("loan", day),
        s.holdings("card", day),
    )
    counts = {
        "total_accounts": "accounts", "cnt_casa_active": "casa_active", "cnt_td_active": "td_active",
        "cnt_deposits": "deposits", "cnt_deposits_active": "deposits_active", "cnt_loans": "loans",
        "cnt_loans_active": "loans_active", "cnt_cards": "cards", "cnt_credit_cards": "credit_active",
        "cnt_debit_cards": "debit_active",
    }
    return rows.select(
        *ID,
        *[_n(source).alias(name) for name, source in counts.items()],
        C.flag(F.col("credit_active") > 0).alias("has_credit_card"),
        C.flag(F.col("deposits_active") > 0).alias("has_savings"),
        C.flag(F.col("loans_active") > 0).alias("has_loan"),
        _stamp(day),
    )


def card_summary(s: Silver, day: dt.date) -> DataFrame:
    rows = star(
        asof_dimension(s.dim_customer, day).select(*ID), s.holdings("card", day), s.activity("card", day)
    )
    return rows.select(
        *ID,
        _n("cards").alias("total_cards"),
        _n("credit_active").alias("cnt_credit_active"),
        _n("debit_active").alias("cnt_debit_active"),
        C.money(F.col("limit_max")).alias("max_credit_limit"),
        _n("cnt_30", "long").alias("total_card_txn_count_30d"),
        C.money(F.col("amt_30")).alias("total_card_txn_amount_30d"),
        C.money(F.try_divide(F.col("amt_30"), F.col("cnt_30"))).alias("avg_card_txn_amount_30d"),
        _n("categories_30").alias("distinct_merchant_categories"),
        F.col("last_30").alias("last_card_txn_date"),
        _stamp(day),
    )


def transaction_summary(s: Silver, day: dt.date) -> DataFrame:
    rows = star(asof_dimension(s.dim_customer, day).select(*ID), *_activity(s, day))
    return rows.select(
        *ID,
        _n("a_cnt_30", "long").alias("acct_txn_count_30d"),
        C.money(F.col("a_amt_30")).alias("acct_txn_amount_30d"),
        _n("a_credit_cnt", "long").alias("acct_credit_count_30d"),
        _n("a_debit_cnt", "long").alias("acct_debit_count_30d"),
        C.money(F.col("a_credit_amt")).alias("acct_credit_amount_30d"),
        C.money(F.col("a_debit_amt")).alias("acct_debit_amount_30d"),
        _n("c_cnt_30", "long").alias("card_txn_count_30d"),
        C.money(F.col("c_amt_30")).alias("card_txn_amount_30d"),
        _both("cnt_30").alias("total_txn_count_30d"),
        C.money(_both("amt_30")).alias("total_txn_amount_30d"),
        _latest(F.col("a_last_30"), F.col("c_last_30")).alias("last_txn_date"),
        _stamp(day),
    )


# --- recency, frequency, monetary ----------------------------------------------------------------


def score(base: DataFrame) -> DataFrame:
    """Add r, f, m in 1..5 to rows with recency_days, frequency, monetary; inactive customers score 1.

    The tiles are cut over active customers only.
    """
    active = F.col("frequency") > 0
    orders = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("monetary")}
    tiled = ntile_over(base, active, orders)
    return tiled.withColumns({n: F.when(active, F.col(n)).otherwise(F.lit(1)) for n in orders})


def ntile_over(rows: DataFrame, subset: Column, orders: dict[str, Column]) -> DataFrame:
    cuts = ntile_cuts(rows.where(subset), KEY, orders)
    kinds = rows.select(*[o.alias(n) for n, o in orders.items()]).schema
    return rows.withColumns({n: tile_of(o, F.col(KEY), cuts[n], kinds[n].dataType) for n, o in orders.items()})


def rfm_segment(s: Silver, day: dt.date) -> DataFrame:
    last = _latest(F.col("a_last_90"), F.col("c_last_90"))
    base = star(asof_dimension(s.dim_customer, day).select(*ID), *_activity(s, day)).select(
        *ID,
        F.when(_both("cnt_90") == 0, C.NEVER_DAYS).otherwise(F.datediff(F.lit(day), last.cast("date"))).alias("recency_days"),
        _both("cnt_90").alias("frequency"),
        C.money(_both("amt_90")).alias("monetary"),
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return score(durable(base, "rfm-base")).select(
        *ID, "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        (r + f + m).alias("rfm_score"),
        C.rfm_segment(F.col("frequency") > 0, r, f, m).alias("rfm_segment"),
        _stamp(day),
    )


def churn_prediction(s: Silver, day: dt.date) -> DataFrame:
    last = _latest(F.col("a_last_365"), F.col("c_last_365"))
    rows = star(asof_dimension(s.dim_customer, day).select(*ID), *_activity(s, day)).withColumns(
        {"never": last == C.ts_lit(C.NEVER_TS), "days": F.datediff(F.lit(day), last.cast("date"))}
    )
    return rows.select(
        *ID,
        _both("cnt_30").alias("txn_cnt_30d"),
        _both("cnt_90").alias("txn_cnt_90d"),
        C.money(_both("amt_30")).alias("txn_amt_30d"),
        C.money(_both("amt_90")).alias("txn_amt_90d"),
        F.col("days").alias("days_since_last_txn"),
        C.churn_risk(F.col("days"), F.col("never")).alias("churn_risk"),
        C.flag(F.col("never") | (F.col("days") > 90)).alias("is_churn_candidate"),
        _stamp(day),
    )


def cross_sell_segment(s: Silver, day: dt.date) -> DataFrame:
    rows = star(
        asof_dimension(s.dim_customer, day).select(*ID, "customer_segment"),
        s.holdings("card", day),
        s.holdings("deposit", day),
        s.holdings("loan", day),
    )
    lacks = lambda name: F.coalesce(F.col(name), F.lit(0)) == 0
    return rows.select(
        *ID,
        "customer_segment",
        C.flag(lacks("credit_active")).alias("no_credit_card"),
        C.flag(lacks("deposits_active")).alias("no_deposit"),
        C.flag(lacks("loans_active")).alias("no_loan"),
        C.ladder(
            [(lacks("credit_active"), "Credit Card"), (lacks("deposits_active"), "Deposit"), (lacks("loans_active"), "Loan")],
            "None",
        ).alias("primary_opportunity"),
        _stamp(day),
    )


# --- the 360 mart --------------------------------------------------------------------------------


def customer_360(s: Silver, day: dt.date) -> DataFrame:
    """33 columns per customer; the joined base is written before it is scored."""
    spine = asof_dimension(s.dim_customer, day).select(
        *ID, "full_name", "gender", "date_of_birth", F.col("branch_code").alias("primary_branch_code"),
        "customer_segment", "kyc_status", "register_date",
    )
    joined = star(
        spine,
        s.holdings("account", day),
        s.holdings("deposit", day),
        s.holdings("loan", day),
        s.holdings("card", day),
        *_activity(s, day),
        A.crm_activity(s.fact_crm_interaction, day),
    )
    zero = F.lit(0)
    last = _latest(F.col("a_last_365"), F.col("c_last_365"))
    base = joined.select(
        *ID,
        C.mask_name_short(F.col("full_name")).alias("full_name_masked"),
        C.years_365(F.col("date_of_birth"), day).alias("age"),
        "gender", "primary_branch_code", "customer_segment", "kyc_status", "register_date",
        _n("accounts").alias("total_accounts"),
        _n("cards").alias("total_cards"),
        _n("loans").alias("total_loans"),
        C.flag(F.col("credit_active") > 0).alias("has_credit_card"),
        C.flag(F.col("deposits_active") > 0).alias("has_savings"),
        C.flag(F.col("loans_active") > 0).alias("has_loan"),
        C.money(F.coalesce(F.col("balance_sum"), zero) + F.coalesce(F.col("principal_sum"), zero)).alias("aum_total"),
        C.money(F.col("outstanding_sum")).alias("total_loan_outstanding"),
        _both("cnt_30").alias("txn_count_30d"),
        C.money(_both("amt_30")).alias("txn_amount_30d"),
        F.nullif(last, C.ts_lit(C.NEVER_TS)).alias("last_txn_date"),
        F.coalesce(F.col("a_primary_channel"), F.lit("UNKNOWN")).alias("primary_channel"),
        _n("interactions_90", "long").alias("interaction_count_90d"),
        F.col("last_interaction").alias("last_interaction_date"),
        _both("cnt_90").alias("frequency"),
        C.money(_both("amt_90")).alias("monetary"),
    ).withColumn(
        "recency_days", F.coalesce(F.datediff(F.lit(day), F.col("last_txn_date").cast("date")), F.lit(C.NEVER_DAYS))
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    rows = score(durable(base, "mart-base")).withColumns(
        {
            "total_deposit_balance": F.col("aum_total"),
            "aum_bucket": C.aum_bucket(F.col("aum_total")),
            "days_since_last_txn": F.col("recency_days"),
            "rfm_recency_score": r,
            "rfm_frequency_score": f,
            "rfm_monetary_score": m,
            "rfm_segment": C.rfm_segment(F.col("frequency") > 0, r, f, m),
            "churn_flag": C.flag(F.col("recency_days") > 90),
            "cross_sell_credit_card_flag": C.flag((F.col("aum_total") >= 100_000_000) & (F.col("has_credit_card") == 0)),
            "cob_dt": F.lit(day),
        }
    )
    return S.assert_schema(rows.select(*S.MART_360.columns), S.MART_360)


# --- next best offer -----------------------------------------------------------------------------


def campaign_target(
    rfm: DataFrame, churn: DataFrame, cross: DataFrame, mart: DataFrame, crm: DataFrame, day: dt.date
) -> DataFrame:
    """Additive score, recommended product with its reasons, priority and suppression for each customer."""
    both = [KEY, "cob_dt"]
    at_day = lambda df: df.where(F.col("cob_dt") == F.lit(day))
    rows = (
        at_day(rfm).select(*both, "customer_sk", "rfm_segment", "rfm_score", "recency_days", "frequency", "monetary")
        .join(at_day(churn).select(*both, "churn_risk", "is_churn_candidate", "days_since_last_txn"), both, "left")
        .join(at_day(cross).select(*both, "primary_opportunity", "no_credit_card", "no_deposit", "no_loan"), both, "left")
        .join(
            at_day(mart).select(*both, "customer_segment", "kyc_status", "aum_total", "aum_bucket", "primary_branch_code"),
            both, "left",
        )
        .join(A.open_complaints(crm, day), KEY, "left")
    )
    yes = lambda c: F.coalesce(c, F.lit(False))
    complaint = yes(F.col("open_complaints") > 0)
    unverified = F.upper(F.coalesce(F.col("kyc_status"), F.lit("UNKNOWN"))) != "VERIFIED"
    high_churn = yes(F.col("churn_risk") == "High")
    valued = F.col("rfm_segment").isin("Champions", "Loyal Customers")
    premium = yes(F.upper("customer_segment").isin("PRIORITY", "VIP"))
    retain = yes(F.col("is_churn_candidate") == 1) & F.col("rfm_segment").isin("At Risk", "Hibernating")
    # Points and wording of each reason.
    reasons = [
        (yes(F.col("no_credit_card") == 1), 30, "No credit card (+30)"),
        (yes(F.col("aum_total") >= 100_000_000), 25, "AUM at least 100m (+25)"),
        (valued, 20, "High-value RFM (+20)"),
        (yes(F.col("days_since_last_txn") <= 30), 15, "Active in last 30 days (+15)"),
        (premium, 10, "Priority/VIP (+10)"),
        (unverified, -30, "KYC not verified (-30)"),
        (high_churn & complaint, -20, "High churn risk and open complaint (-20)"),
        (high_churn & ~complaint, -20, "High churn risk (-20)"),
        (~high_churn & complaint, -20, "Open complaint (-20)"),
    ]
    points = sum((F.when(when, F.lit(value)).otherwise(F.lit(0)) for when, value, _ in reasons), F.lit(0))
    wording = F.concat_ws("; ", *[F.when(when, F.lit(text)) for when, _, text in reasons])
    product = C.ladder(
        [
            (retain, "RETENTION_OFFER"),
            (F.col("no_credit_card") == 1, "CREDIT_CARD"),
            (F.col("no_deposit") == 1, "TERM_DEPOSIT"),
            (F.col("no_loan") == 1, "PERSONAL_LOAN"),
            (premium, "WEALTH_MANAGEMENT"),
        ],
        "DIGITAL_SAVINGS",
    )
    scored = rows.withColumns(
        {
            "cross_sell_score": F.greatest(F.lit(0), F.least(F.lit(100), points)).cast("int"),
            "recommended_product": product,
            "recommendation_reason": F.coalesce(F.nullif(wording, F.lit("")), F.lit("Baseline product fit")),
            "_blocked": unverified | complaint,
            "_unverified": unverified,
            "_retain": retain,
            "_valued": valued,
        }
    )
    blocked, points_col = F.col("_blocked"), F.col("cross_sell_score")
    return scored.select(
        *ID, "rfm_segment", "rfm_score", "recency_days", "frequency", "monetary", "churn_risk", "is_churn_candidate",
        "days_since_last_txn", "customer_segment", "aum_total", "aum_bucket", "primary_branch_code",
        "primary_opportunity", "no_credit_card", "no_deposit", "no_loan", "cross_sell_score", "recommended_product",
        "recommendation_reason",
        C.ladder([(blocked, "LOW"), (points_col >= 70, "HIGH"), (points_col >= 40, "MEDIUM")], "LOW").alias("campaign_priority"),
        (~blocked).cast("int").alias("contact_eligible_flag"),
        F.when(F.col("_unverified"), "KYC_NOT_VERIFIED").when(blocked, "OPEN_COMPLAINT").alias("suppression_reason"),
        C.ladder(
            [
                (F.col("_retain"), "Retention"),
                (F.col("recommended_product") == "CREDIT_CARD", "Cross_Sell_CC"),
                (F.col("recommended_product").isin("TERM_DEPOSIT", "PERSONAL_LOAN"), "Cross_Sell"),
                (F.col("_valued"), "Upsell"),
            ],
            "Awareness",
        ).alias("campaign_type"),
        "cob_dt",
    )


# --- branches by month ---------------------------------------------------------------------------


def branch_monthly_summary(s: Silver, day: dt.date, bootstrap: bool = False) -> DataFrame:
    """Branch x year x month activity, branch taken from the account version valid on the event date.

    The months come from the stored state where there is one for the day; otherwise from all events up to the day.
    """
    total = s.months(day) if s.months and not bootstrap else None
    if total is None:
        events = s.fact_txn_account.where(F.col("cob_dt") <= F.lit(day))  # a rebuilt day does not see later events
        total = B.month_rows(B.state_of(B.attributed(events, s.dim_account, bootstrap)))
    branches = asof_dimension(s.dim_branch, day).select("branch_code", "branch_name", "region", "city")
    return total.join(branches, "branch_code", "left").select(
        "branch_code", "branch_name", "region", "city", "txn_year", "txn_month",
        F.ceil(F.col("txn_month") / 3).cast("int").alias("txn_quarter"),
        "active_customers",
        F.col("n").alias("txn_count"),
        C.money(F.col("amount")).alias("total_txn_amount"),
        C.money(F.try_divide(F.col("amount"), F.col("n"))).alias("avg_txn_amount"),
        C.money(F.col("credit")).alias("total_credit_amount"),
        C.money(F.col("debit")).alias("total_debit_amount"),
        "top_channel",
        _stamp(day),
    )
