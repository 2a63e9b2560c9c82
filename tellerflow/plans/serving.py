"""Masked serving tables and the guarded dashboard publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions import columns as C
from tellerflow.operators import sinks


def customer_masked(history: DataFrame, day: dt.date, salt: str) -> DataFrame:
    """All versions of the customer dimension without raw personal data."""
    col = F.col
    return history.select(
        "customer_sk",
        "customer_id",
        C.mask_name_full(col("full_name")).alias("full_name_masked"),
        "gender",
        C.birth_decade(col("date_of_birth"), day).alias("age_group_decade"),
        C.mask_phone(col("phone")).alias("phone_masked"),
        C.mask_email(col("email")).alias("email_masked"),
        C.hash_national_id(col("cccd"), salt).alias("cccd_hash"),
        "city", "district", "branch_code", "customer_segment", "kyc_status", "register_date", "is_active",
        "effective_from", "effective_to", "is_current", "last_updated",
    )


def current_mart(history: DataFrame, day: dt.date) -> DataFrame:
    """The requested snapshot of the history mart."""
    return history.where(F.col("cob_dt") == F.lit(day)).select(*S.MART_360.columns)


def mart_masked(current: DataFrame) -> DataFrame:
    """The current mart; its 33 declared columns hold no raw personal data."""
    rows = S.assert_schema(current, S.MART_360)
    exposed = S.exposed_pii(rows)
    if exposed:
        raise ValueError(f"serving columns expose {exposed}")
    return rows


def dashboard_mart(history: DataFrame, campaign: DataFrame, day: dt.date) -> DataFrame:
    """History mart with the offer columns of the same customer and date: 46 declared columns."""
    both = ["customer_id", "cob_dt"]
    offer = [
        "churn_risk", "is_churn_candidate", "no_credit_card", "no_deposit", "no_loan", "cross_sell_score",
        "recommended_product", "recommendation_reason", "campaign_priority", "contact_eligible_flag",
        "suppression_reason", "campaign_type",
    ]
    at_day = F.col("cob_dt") == F.lit(day)
    rows = (
        history.where(at_day)
        .join(campaign.where(at_day).select(*both, *offer), both, "left")
        .withColumn("age_group", C.age_group(F.col("age")))
    )
    return S.assert_schema(rows.select(*S.DASHBOARD_360.columns), S.DASHBOARD_360)


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def offer_rules() -> dict[str, Column]:
    """What can be wrong with an offer row, one condition per rule; unknown values count as wrong."""
    score, eligible = F.col("cross_sell_score"), F.col("contact_eligible_flag")
    suppressed = F.col("suppression_reason").isNotNull()
    valid = lambda c: F.coalesce(c, F.lit(False))
    return {
        "invalid_score": ~valid(score.between(0, 100)),
        "missing_product": _blank("recommended_product"),
        "missing_reason": _blank("recommendation_reason"),
        "invalid_priority": ~valid(F.col("campaign_priority").isin("HIGH", "MEDIUM", "LOW")),
        "invalid_suppression": ~valid(eligible.isin(0, 1)) | ((eligible == 1) == suppressed),
    }


def invalid_offer() -> Column:
    found = F.lit(False)
    for condition in offer_rules().values():
        found = found | F.coalesce(condition, F.lit(True))
    return found


def publish_stats(rows: DataFrame) -> DataFrame:
    """One row the publish guard decides on."""
    per_customer = rows.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_if(invalid_offer()).alias("bad"))
    return per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("unique_customers"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_nbo"),
    )


def publish_dashboard(rows: DataFrame, path: str, day: dt.date) -> int:
    """Overwrite the day's partition only when the rows keep the serving contract, then count it back."""
    spark = rows.sparkSession
    staged = sinks.durable(rows, "dashboard")
    stats = publish_stats(staged).first()
    if not stats.row_count:
        raise RuntimeError(f"dashboard rows for {day} are empty")
    if stats.row_count != stats.unique_customers:
        raise RuntimeError(f"dashboard grain broken for {day}: {stats.asDict()}")
    if stats.invalid_nbo:
        raise RuntimeError(f"dashboard has {stats.invalid_nbo} invalid offers for {day}")
    sinks.overwrite_partitions(staged, path)
    published = spark.read.parquet(path).where(F.col("cob_dt") == F.lit(day)).count()
    if published != stats.row_count:
        raise RuntimeError(f"dashboard publish wrote {published} of {stats.row_count} rows for {day}")
    return published
