"""Dashboard datasets (DB)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.lake import Lake
from tellerflow.plans import dashboard
from tellerflow.queries.business import avg_scaled
from tellerflow.queries.registry import query

_VIEW = """SELECT *, coalesce(map {'CREDIT_CARD': 'Credit Card', 'DIGITAL_SAVINGS': 'Digital Savings', 'PERSONAL_LOAN': 'Personal Loan',
    'TERM_DEPOSIT': 'Term Deposit', 'WEALTH_MANAGEMENT': 'Wealth Management'}[recommended_product], replace(recommended_product, '_', ' ')) AS recommended_product_name,
  CASE WHEN days_since_last_txn > 90 THEN 'Very High' WHEN days_since_last_txn > 60 THEN 'High' WHEN days_since_last_txn > 30 THEN 'Medium'
    WHEN days_since_last_txn > 7 THEN 'Low' ELSE 'Very Low' END AS churn_risk_bucket,
  CASE WHEN cross_sell_score > 89 THEN '90-100' ELSE (cross_sell_score // 10 * 10) || '-' || (cross_sell_score // 10 * 10 + 9) END AS score_bucket
FROM s_dash"""


@query("dash_snapshot_view", _VIEW)
def dash_snapshot_view(lake: Lake) -> DataFrame:
    return dashboard.snapshot_view(lake.dashboard())


@query("dash_kpis", f"""
SELECT count(*) AS customer_count, sum(aum_total) AS total_aum, {avg_scaled('aum_total', 0, 2)} AS avg_aum,
  count(*) FILTER (WHERE txn_count_30d > 0) AS active_30d_customers, sum(contact_eligible_flag) AS eligible_customers,
  {avg_scaled('cross_sell_score', 0, 2)} AS avg_cross_sell_score, sum(is_churn_candidate) AS churn_candidates,
  sum(has_credit_card) AS credit_card_customers, sum(has_savings) AS savings_customers, sum(has_loan) AS loan_customers FROM s_dash""")
def dash_kpis(lake: Lake) -> DataFrame:
    return dashboard.kpis(lake.dashboard())


def _counts(dimension: str, rows: int, source: str = "s_dash") -> str:
    return f"SELECT {dimension}, count(DISTINCT customer_id) AS customers FROM {source} GROUP BY {dimension} ORDER BY 2 DESC, 1 LIMIT {rows}"


@query("dash_rfm_distribution", _counts("rfm_segment", 10))
def dash_rfm_distribution(lake: Lake) -> DataFrame:
    return dashboard.customers_by(lake.dashboard(), "rfm_segment", 10)


@query("dash_aum_by_branch", "SELECT primary_branch_code, sum(aum_total) AS branch_total_aum FROM s_dash GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def dash_aum_by_branch(lake: Lake) -> DataFrame:
    return dashboard.top(lake.dashboard(), "primary_branch_code", F.sum("aum_total"), "branch_total_aum", 10)


@query("dash_product_mix", _counts("recommended_product_name", 10, f"({_VIEW})"))
def dash_product_mix(lake: Lake) -> DataFrame:
    return dashboard.customers_by(dashboard.snapshot_view(lake.dashboard()), "recommended_product_name", 10)


@query("dash_campaign_priority", _counts("campaign_priority", 10))
def dash_campaign_priority(lake: Lake) -> DataFrame:
    return dashboard.customers_by(lake.dashboard(), "campaign_priority", 10)


@query("dash_churn_risk", _counts("churn_risk_bucket", 10, f"({_VIEW})"))
def dash_churn_risk(lake: Lake) -> DataFrame:
    return dashboard.customers_by(dashboard.snapshot_view(lake.dashboard()), "churn_risk_bucket", 10)


@query("dash_score_distribution", _counts("score_bucket", 20, f"({_VIEW})"))
def dash_score_distribution(lake: Lake) -> DataFrame:
    return dashboard.customers_by(dashboard.snapshot_view(lake.dashboard()), "score_bucket", 20)


@query("dash_product_penetration", """
SELECT product, sum(has) AS has_product_customers, sum(lacks) AS eligible_without_product_customers FROM (
  SELECT unnest(['Credit Card', 'Savings', 'Loan']) AS product, unnest([has_credit_card, has_savings, has_loan]) AS has, unnest([no_credit_card, no_deposit, no_loan]) AS lacks
  FROM s_dash) GROUP BY product""")
def dash_product_penetration(lake: Lake) -> DataFrame:
    return dashboard.product_penetration(dashboard.snapshot_view(lake.dashboard()))


@query("dash_customer_drilldown", """
SELECT customer_id, full_name_masked, customer_segment, aum_bucket, rfm_segment, recommended_product, campaign_priority, cross_sell_score
FROM s_dash ORDER BY customer_id LIMIT 10001""")
def dash_customer_drilldown(lake: Lake) -> DataFrame:
    return dashboard.drilldown(lake.dashboard())
