"""Datasets the dashboard reads from the serving table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions.columns import ladder
from tellerflow.plans.business import mean

col, lit = F.col, F.lit

# Display names of products.
PRODUCT_NAMES = {
    "CREDIT_CARD": "Credit Card",
    "DIGITAL_SAVINGS": "Digital Savings",
    "PERSONAL_LOAN": "Personal Loan",
    "TERM_DEPOSIT": "Term Deposit",
    "WEALTH_MANAGEMENT": "Wealth Management",
}


def product_name(code: Column) -> Column:
    names = F.create_map(*[lit(text) for pair in PRODUCT_NAMES.items() for text in pair])
    return F.coalesce(F.element_at(names, code), F.replace(code, lit("_"), lit(" ")))


def churn_bucket(days: Column) -> Column:
    return ladder([(days <= 7, "Very Low"), (days <= 30, "Low"), (days <= 60, "Medium"), (days <= 90, "High")], "Very High")


def score_bucket(score: Column) -> Column:
    low = (F.floor(score / 10) * 10).cast("int")
    return F.when(score >= 90, lit("90-100")).otherwise(F.concat(low.cast("string"), lit("-"), (low + 9).cast("string")))


def snapshot_view(mart: DataFrame) -> DataFrame:
    return mart.withColumns(
        {
            "recommended_product_name": product_name(col("recommended_product")),
            "churn_risk_bucket": churn_bucket(col("days_since_last_txn")),
            "score_bucket": score_bucket(col("cross_sell_score")),
        }
    )


def kpis(mart: DataFrame) -> DataFrame:
    """Totals of one snapshot; a customer is in it once, as the publish guard has checked."""
    return mart.agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("aum_total").alias("total_aum"),
        mean("aum_total", 1, 2).alias("avg_aum"),
        F.count_if(col("txn_count_30d") > 0).alias("active_30d_customers"),
        F.sum("contact_eligible_flag").alias("eligible_customers"),
        mean("cross_sell_score", 1, 2).alias("avg_cross_sell_score"),
        F.sum("is_churn_candidate").alias("churn_candidates"),
        F.sum("has_credit_card").alias("credit_card_customers"),
        F.sum("has_savings").alias("savings_customers"),
        F.sum("has_loan").alias("loan_customers"),
    )


def top(mart: DataFrame, dimension: str, measure: Column, name: str, rows: int) -> DataFrame:
    """One bar chart: a measure per value of a dimension, the largest first."""
    return mart.groupBy(dimension).agg(measure.alias(name)).orderBy(col(name).desc(), dimension).limit(rows)


def customers_by(mart: DataFrame, dimension: str, rows: int) -> DataFrame:
    return top(mart, dimension, F.count("customer_id"), "customers", rows)


def product_rows(view: DataFrame) -> DataFrame:
    """One row per customer and product with owned and eligible flags, from a single scan."""
    dims = ["cob_dt", "primary_branch_code", "customer_segment", "rfm_segment", "campaign_priority", "recommended_product", "recommended_product_name"]
    return view.selectExpr(
        *dims,
        "stack(3, 'Credit Card', has_credit_card, no_credit_card, 'Savings', has_savings, no_deposit, 'Loan', has_loan, no_loan)"
        " AS (product, has_product_customers, eligible_without_product_customers)",
    )


def product_penetration(view: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("has_product_customers", "eligible_without_product_customers")]
    return product_rows(view).groupBy("product").agg(*sums).orderBy(col("eligible_without_product_customers").desc(), "product").limit(10)


def drilldown(mart: DataFrame, rows: int = 10_001) -> DataFrame:
    """The table report: eight safe columns, at most one page more than can be shown."""
    return mart.select(
        "customer_id", "full_name_masked", "customer_segment", "aum_bucket", "rfm_segment", "recommended_product", "campaign_priority", "cross_sell_score"
    ).orderBy("customer_id").limit(rows)
