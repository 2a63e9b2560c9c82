"""Data-quality runner and its 19 checks (DQ)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.lake import Lake
from tellerflow.operators import sinks
from tellerflow.plans import quality
from tellerflow.queries.oracle import D, raw_values
from tellerflow.queries.registry import query

BAD_OFFER = """(cross_sell_score IS NULL OR cross_sell_score < 0 OR cross_sell_score > 100 OR coalesce(trim(recommended_product), '') = ''
  OR coalesce(trim(recommendation_reason), '') = '' OR coalesce(campaign_priority, '') NOT IN ('LOW', 'MEDIUM', 'HIGH')
  OR coalesce(contact_eligible_flag, 9) NOT IN (0, 1) OR (contact_eligible_flag = 1) = (suppression_reason IS NOT NULL))"""


def _texts(ddl: str) -> list[str]:
    """The text columns of a declared schema."""
    return re.findall(r"(\w+) string\b", ddl, re.IGNORECASE)


def _dup(view: str, key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {view} GROUP BY {key} HAVING count(*) > 1))"


def _missing(a: str, b: str) -> str:
    return f"(SELECT count(*) FROM {a} x FULL JOIN {b} y ON x.customer_id = y.customer_id WHERE x.customer_id IS NULL OR y.customer_id IS NULL)"


def _overlaps(dim: str) -> str:
    return (
        f"SELECT 1 FROM (SELECT effective_from, lag(effective_to) OVER (PARTITION BY business_key ORDER BY effective_from, effective_to) AS p "
        f"FROM v_all WHERE dim = '{dim}') WHERE effective_from <= p"
    )


_OVER = "(SELECT count(*) FROM (" + " UNION ALL ".join(_overlaps(f"dim_{e}") for e in ("customer", "account", "product", "branch")) + "))"
_N = "(SELECT count(*) FROM g_mart)"
SQL = {
    "mart_customer_360_current_contract": (
        f"{_dup('g_mart', 'customer_id')} + (SELECT count(*) FROM g_mart WHERE cob_dt <> DATE '{D}') + CASE WHEN {_N} = 0 THEN 1 ELSE 0 END", _N),
    "scd2_single_current_row": (
        "(SELECT count(*) FROM (SELECT 1 FROM v_all WHERE is_current = 1 GROUP BY dim, business_key HAVING count(*) > 1))", "(SELECT count(*) FROM v_all)"),
    "scd2_no_effective_range_overlap": (_OVER, _OVER),
    "scd2_valid_ranges_and_current_expiry": (
        "(SELECT count(*) FROM v_all WHERE effective_from > effective_to OR (is_current = 1 AND effective_to < DATE '9999-12-31'))", "(SELECT count(*) FROM v_all)"),
    "fact_surrogate_keys_not_orphan": (
        "(SELECT count(*) FROM f_acct WHERE account_sk IS NULL OR customer_sk IS NULL) + (SELECT count(*) FROM f_card WHERE customer_sk IS NULL) "
        "+ (SELECT count(*) FROM f_crm WHERE customer_sk IS NULL)",
        "(SELECT count(*) FROM f_acct) + (SELECT count(*) FROM f_card) + (SELECT count(*) FROM f_crm)"),
    "business_flags_are_binary": (
        "(SELECT count(*) FROM g_mart WHERE greatest(has_credit_card, has_savings, has_loan, churn_flag, cross_sell_credit_card_flag) > 1) "
        "+ (SELECT count(*) FROM g_churn WHERE is_churn_candidate > 1) + (SELECT count(*) FROM g_cross WHERE greatest(no_credit_card, no_deposit, no_loan) > 1)",
        "(SELECT count(*) FROM g_mart) + (SELECT count(*) FROM g_churn) + (SELECT count(*) FROM g_cross)"),
    "rfm_scores_in_valid_range": (
        "(SELECT count(*) FROM g_rfm WHERE least(r_score, f_score, m_score) < 1 OR greatest(r_score, f_score, m_score) > 5 OR rfm_score < 3 OR rfm_score > 15)",
        "(SELECT count(*) FROM g_rfm)"),
    "campaign_unique_customer_date": (_dup("g_campaign", "customer_id, cob_dt"), "(SELECT count(*) FROM g_campaign)"),
    "nbo_contract_is_valid": (f"(SELECT count(*) FROM g_campaign WHERE {BAD_OFFER})", "(SELECT count(*) FROM g_campaign)"),
    "segmentation_population_matches_current": (
        " + ".join(f"abs((SELECT count(*) FROM {v}) - {_N})" for v in ("g_rfm", "g_churn", "g_cross", "g_campaign")), f"4 * {_N}"),
    "gold_customer_population_matches_silver": (_missing("h_cust", "g_mart"), "(SELECT count(*) FROM h_cust)"),
    "aum_reconciles_to_independent_sources": (
        "(SELECT count(*) FROM g_mart JOIN g_balance b USING (customer_id) WHERE g_mart.aum_total <> b.aum_total OR g_mart.total_loan_outstanding <> b.total_loan_outstanding)",
        "(SELECT count(*) FROM h_cust)"),
    "masked_mart_matches_gold_current": (_missing("g_mart", "(SELECT customer_id FROM g_mart)"), _N),
    "masked_mart_has_no_raw_pii_columns": (raw_values("g_mart", _texts(S.MART_360.ddl)), "(SELECT count(*) FROM g_mart)"),
    "dashboard_customer_date_is_unique": (_dup("s_dash", "customer_id, cob_dt"), "(SELECT count(*) FROM s_dash)"),
    "dashboard_population_matches_gold_history": (_missing("g_mart", "s_dash"), _N),
    "dashboard_nbo_contract_is_valid": (f"(SELECT count(*) FROM s_dash WHERE {BAD_OFFER})", "(SELECT count(*) FROM s_dash)"),
    "dashboard_has_no_raw_pii_columns": (raw_values("s_dash", _texts(S.DASHBOARD_360.ddl)), "(SELECT count(*) FROM s_dash)"),
    "all_rfm_segments_reachable": ("7 - (SELECT count(DISTINCT rfm_segment) FROM g_rfm)", "(SELECT count(*) FROM g_rfm)"),
}


def _register(check: quality.Check) -> None:
    failed, total = SQL[check.name]

    @query(check.name, f"SELECT {failed} AS failed_count, {total} AS total_count")
    def run(lake: Lake) -> DataFrame:
        return check.run(lake.tables(), lake.day)


for _check in quality.CHECKS:
    _register(_check)


def _all_checks_sql(columns: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c.name}' AS check_name, '{c.severity}' AS severity, {SQL[c.name][0]} AS failed_count, {SQL[c.name][1]} AS total_count" for c in quality.CHECKS
    )
    return f"SELECT {columns} FROM ({rows})"


@query("dq_run_checks", _all_checks_sql("check_name, severity, failed_count, total_count, failed_count = 0 AS passed"))
def dq_run_checks(lake: Lake) -> DataFrame:
    return quality.check_frame(quality.CHECKS, lake.tables(), lake.day)


@query("dq_result_log", _all_checks_sql(
    f"check_name, severity, DATE '{D}' AS cob_dt, 'daily' AS pipeline_run_id, 'dq-1' AS dq_run_id, failed_count = 0 AS passed, failed_count, total_count"))
def dq_result_log(lake: Lake) -> DataFrame:
    """Run, store and read back the result rows."""
    path = f"{lake.root}/dq-results-{uuid.uuid4().hex[:8]}"
    results = quality.run_checks(quality.CHECKS, lake.tables(), lake.day, "daily", "dq-1")
    sinks.append(quality.result_frame(lake.spark, results), path)
    stored = lake.spark.read.parquet(path)
    return stored.select("check_name", "severity", "cob_dt", "pipeline_run_id", "dq_run_id", "passed", "failed_count", "total_count")


@query("dq_gate", _all_checks_sql(
    "severity, count(*) AS checks, count(*) FILTER (WHERE failed_count <> 0) AS failed, bool_or(failed_count <> 0) AND severity = 'critical' AS blocks") + " GROUP BY severity")
def dq_gate(lake: Lake) -> DataFrame:
    """What the gate decides on: any failed critical check blocks, warnings never do."""
    rows = quality.check_frame(quality.CHECKS, lake.tables(), lake.day)
    return rows.groupBy("severity").agg(
        F.count("*").alias("checks"), F.count_if(~F.col("passed")).alias("failed"),
        (F.bool_or(~F.col("passed")) & (F.first("severity") == "critical")).alias("blocks"),
    )
