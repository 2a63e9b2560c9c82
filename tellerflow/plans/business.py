"""Business questions over the masked mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerflow.functions.columns import ladder

col, lit = F.col, F.lit
MILLION, BILLION = 1_000_000, 1_000_000_000
SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "At Risk", "Hibernating", "Lost"]


def scaled(value: Column, unit: int, digits: int) -> Column:
    """Money in millions or billions at a fixed number of digits, half up."""
    return F.round(value / lit(unit), digits).cast(f"decimal(18,{digits})")


def mean(value: str, unit: int, digits: int) -> Column:
    """Average of an exact sum, scaled; kept decimal so that rounding is exact."""
    total = F.sum(col(value).cast("decimal(18,2)"))
    return F.round(total / (F.count(value).cast("decimal(12,0)") * lit(unit)), digits).cast(f"decimal(18,{digits})")


def rank_of(column: str, order: list[str]) -> Column:
    return ladder([(col(column) == name, i) for i, name in enumerate(order)], len(order))


def cross_sell_credit_card(mart: DataFrame, prefix: str, top: int = 1000) -> DataFrame:
    """Wealthy, active, loyal customers of a branch group who hold no credit card; the richest first."""
    wanted = (
        (col("has_credit_card") == 0) & (col("aum_total") > 100_000_000)
        & col("rfm_segment").isin("Champions", "Loyal Customers") & (col("days_since_last_txn") <= 30)
        & col("primary_branch_code").startswith(prefix)
    )
    return mart.where(wanted).orderBy(col("aum_total").desc(), "customer_id").limit(top).select(
        "customer_id", "full_name_masked", "primary_branch_code", "customer_segment",
        scaled(col("aum_total"), MILLION, 1).alias("aum_million_vnd"), "aum_bucket", "rfm_segment", "txn_count_30d",
        scaled(col("txn_amount_30d"), MILLION, 1).alias("txn_amount_30d_million"), "days_since_last_txn", "last_txn_date",
        "primary_channel", "interaction_count_90d",
    )


def churn_risk_customers(mart: DataFrame, churn: DataFrame, top: int = 500) -> DataFrame:
    """Premium customers with assets who stopped transacting."""
    both = ["customer_id", "cob_dt"]
    lost = mart.where((col("churn_flag") == 1) & (col("aum_total") >= 50_000_000) & col("customer_segment").isin("PRIORITY", "VIP"))
    facts = churn.select(*both, col("days_since_last_txn").alias("idle"), "churn_risk", "txn_cnt_30d", "txn_cnt_90d")
    rows = lost.join(facts, both).orderBy(col("aum_total").desc(), col("idle").desc(), "customer_id").limit(top)
    return rows.select(
        "customer_id", "full_name_masked", "primary_branch_code", "customer_segment",
        scaled(col("aum_total"), MILLION, 1).alias("aum_million_vnd"), "aum_bucket", "rfm_segment",
        col("idle").alias("days_since_last_txn"), "churn_risk", "txn_cnt_30d", "txn_cnt_90d", "interaction_count_90d",
        col("primary_channel").alias("last_active_channel"),
    )


def rfm_segment_distribution(mart: DataFrame) -> DataFrame:
    """Size, share and averages of each segment in business order."""
    rows = mart.groupBy("rfm_segment").agg(
        F.count("*").alias("customer_count"),
        mean("aum_total", MILLION, 1).alias("avg_aum_million"),
        scaled(F.sum("aum_total"), BILLION, 1).alias("total_aum_billion"),
        mean("txn_count_30d", 1, 1).alias("avg_txn_30d"),
        mean("txn_amount_30d", MILLION, 1).alias("avg_txn_amt_30d_million"),
        F.count_if(col("has_credit_card") == 0).alias("no_credit_card_cnt"),
        F.count_if(col("churn_flag") == 1).alias("churn_flag_cnt"),
    )
    n = col("customer_count").cast("decimal(12,0)")
    share = F.round(n * 100 / F.sum(n).over(Window.partitionBy()), 1)  # over the aggregated rows: one per segment
    return rows.withColumn("pct_of_total", share.cast("decimal(18,1)")).orderBy(rank_of("rfm_segment", SEGMENTS))


def aum_by_branch(mart: DataFrame, top: int = 50) -> DataFrame:
    """Assets, opportunity and activity of each branch; the largest first."""
    count = lambda condition: F.count_if(condition)
    segment = col("customer_segment")
    rows = mart.groupBy(F.substring("primary_branch_code", 1, 3).alias("region_prefix"), "primary_branch_code").agg(
        F.count("*").alias("total_customers"),
        count(segment == "VIP").alias("vip_count"),
        count(segment == "PRIORITY").alias("priority_count"),
        count(segment == "RETAIL").alias("retail_count"),
        scaled(F.sum("aum_total"), BILLION, 2).alias("total_aum_billion"),
        mean("aum_total", MILLION, 1).alias("avg_aum_million"),
        count((col("has_credit_card") == 0) & (col("aum_total") >= 100_000_000)).alias("cross_sell_cc_opportunity"),
        count(col("churn_flag") == 1).alias("churn_risk_count"),
        count(col("days_since_last_txn") <= 30).alias("active_30d"),
    )
    return rows.orderBy(col("total_aum_billion").desc(), "primary_branch_code").limit(top)


def customer_profile(mart: DataFrame, campaign: DataFrame, customer_id: int) -> DataFrame:
    """Everything about one customer on one row, with the recommended campaign."""
    both = ["customer_id", "cob_dt"]
    only = col("customer_id") == customer_id
    offer = campaign.where(only).select(*both, col("campaign_type").alias("recommended_campaign"))
    million = lambda name: scaled(col(name), MILLION, 1)
    return mart.where(only).join(offer, both, "left").select(
        "customer_id", "full_name_masked", "age", "gender", "customer_segment", "primary_branch_code", "kyc_status",
        "total_accounts", "total_cards", "total_loans", "has_credit_card", "has_savings", "has_loan",
        million("aum_total").alias("aum_million_vnd"), "aum_bucket",
        million("total_deposit_balance").alias("deposit_balance_million"),
        million("total_loan_outstanding").alias("loan_outstanding_million"),
        "txn_count_30d", million("txn_amount_30d").alias("txn_amount_30d_million"), "days_since_last_txn",
        "primary_channel", "interaction_count_90d", "last_interaction_date", "rfm_recency_score",
        "rfm_frequency_score", "rfm_monetary_score", "rfm_segment", "churn_flag", "cross_sell_credit_card_flag",
        "recommended_campaign",
    )


def product_penetration(mart: DataFrame) -> DataFrame:
    """Ownership and opportunity per segment and asset bucket, with the fee a 20 % conversion would bring.

    Opportunity counts are NULL, not zero, where nobody qualifies.
    """
    some = lambda condition: F.sum(F.when(condition, lit(1)))
    percent = lambda name: F.round(F.sum(name).cast("decimal(12,0)") * 100 / F.count(name), 1).cast("decimal(18,1)")
    no_card = col("has_credit_card") == 0
    rows = mart.groupBy("customer_segment", "aum_bucket").agg(
        F.count("*").alias("total"),
        percent("has_credit_card").alias("pct_has_credit_card"),
        percent("has_savings").alias("pct_has_savings"),
        percent("has_loan").alias("pct_has_loan"),
        some(no_card).alias("opportunity_cc"),
        some(col("has_savings") == 0).alias("opportunity_deposit"),
        some(col("has_loan") == 0).alias("opportunity_loan"),
        scaled(F.sum(F.when(no_card, col("aum_total")).otherwise(lit(0))), BILLION, 2).alias("cc_opportunity_aum_billion"),
        some(no_card & (col("days_since_last_txn") <= 30)).alias("cc_opportunity_active_30d"),
    )
    fee = F.round(col("opportunity_cc").cast("decimal(12,0)") * 6 / 100, 1).cast("decimal(18,1)")  # 20 % x 300k, in millions
    return rows.withColumn("estimated_fee_revenue_million_vnd", fee).orderBy(
        rank_of("customer_segment", ["VIP", "PRIORITY"]), rank_of("aum_bucket", ["VIP", "PRIORITY", "AFFLUENT"])
    )
