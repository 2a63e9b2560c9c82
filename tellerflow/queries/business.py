"""Business queries (BQ)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tellerflow.lake import Lake
from tellerflow.plans import business
from tellerflow.queries.oracle import half_up
from tellerflow.queries.registry import query


def mil(column: str, unit: str = "0.000001", digits: int = 1) -> str:
    return f"CAST(round({column} * {unit}, {digits}) AS DECIMAL(18,{digits}))"


def avg_scaled(column: str, zeros: int, digits: int) -> str:
    """Exact half-up average of a two-decimal sum, divided by 10**zeros."""
    n = f"(count(*) * CAST({10**zeros} AS HUGEINT))"
    return f"CAST({half_up(f'sum(CAST({column} AS DECIMAL(18,2)))', n, digits)} AS DECIMAL(18,{digits}))"


@query("cross_sell_credit_card", f"""
SELECT customer_id, full_name_masked, primary_branch_code, customer_segment, {mil('aum_total')} AS aum_million_vnd, aum_bucket, rfm_segment,
  txn_count_30d, {mil('txn_amount_30d')} AS txn_amount_30d_million, days_since_last_txn, last_txn_date, primary_channel, interaction_count_90d
FROM g_mart WHERE has_credit_card = 0 AND aum_total > 100000000 AND rfm_segment IN ('Loyal Customers', 'Champions') AND days_since_last_txn < 31
  AND primary_branch_code LIKE 'B01%' ORDER BY aum_total DESC, customer_id LIMIT 1000""")
def cross_sell_credit_card(lake: Lake) -> DataFrame:
    return business.cross_sell_credit_card(lake.masked(), "B01")


@query("churn_risk_customers", f"""
SELECT m.customer_id, m.full_name_masked, m.primary_branch_code, m.customer_segment, {mil('m.aum_total')} AS aum_million_vnd, m.aum_bucket,
  m.rfm_segment, h.days_since_last_txn, h.churn_risk, h.txn_cnt_30d, h.txn_cnt_90d, m.interaction_count_90d, m.primary_channel AS last_active_channel
FROM g_mart m, g_churn h WHERE m.customer_id = h.customer_id AND m.churn_flag = 1 AND m.aum_total >= 50000000 AND m.customer_segment <> 'RETAIL'
ORDER BY m.aum_total DESC, h.days_since_last_txn DESC, m.customer_id LIMIT 500""")
def churn_risk_customers(lake: Lake) -> DataFrame:
    return business.churn_risk_customers(lake.masked(), lake.gold("churn_prediction"))


BQ3 = f"""
SELECT rfm_segment, count(*) AS customer_count,
  CAST(CAST((2000 * count(*) + (SELECT count(*) FROM g_mart)) // (2 * (SELECT count(*) FROM g_mart)) AS DECIMAL(12,0)) * 0.1 AS DECIMAL(18,1)) AS pct_of_total,
  {avg_scaled('aum_total', 6, 1)} AS avg_aum_million, {mil('sum(aum_total)', '0.000000001')} AS total_aum_billion,
  {avg_scaled('txn_count_30d', 0, 1)} AS avg_txn_30d, {avg_scaled('txn_amount_30d', 6, 1)} AS avg_txn_amt_30d_million,
  count(*) FILTER (WHERE has_credit_card = 0) AS no_credit_card_cnt, count(*) FILTER (WHERE churn_flag = 1) AS churn_flag_cnt
FROM g_mart GROUP BY rfm_segment"""


@query("rfm_segment_distribution", BQ3)
def rfm_segment_distribution(lake: Lake) -> DataFrame:
    return business.rfm_segment_distribution(lake.masked())


@query("aum_by_branch", f"""
SELECT primary_branch_code[1:3] AS region_prefix, primary_branch_code, count(*) AS total_customers,
  count(*) FILTER (WHERE customer_segment = 'VIP') AS vip_count, count(*) FILTER (WHERE customer_segment = 'PRIORITY') AS priority_count,
  count(*) FILTER (WHERE customer_segment = 'RETAIL') AS retail_count, {mil('sum(aum_total)', '0.000000001', 2)} AS total_aum_billion,
  {avg_scaled('aum_total', 6, 1)} AS avg_aum_million,
  count(*) FILTER (WHERE cross_sell_credit_card_flag = 1) AS cross_sell_cc_opportunity, count(*) FILTER (WHERE churn_flag = 1) AS churn_risk_count,
  count(*) FILTER (WHERE days_since_last_txn < 31) AS active_30d
FROM g_mart GROUP BY ALL ORDER BY total_aum_billion DESC, primary_branch_code LIMIT 50""")
def aum_by_branch(lake: Lake) -> DataFrame:
    return business.aum_by_branch(lake.masked())


@query("customer_profile", f"""
SELECT m.customer_id, full_name_masked, age, gender, m.customer_segment, m.primary_branch_code, kyc_status, total_accounts, total_cards, total_loans,
  has_credit_card, has_savings, has_loan, {mil('m.aum_total')} AS aum_million_vnd, m.aum_bucket, {mil('total_deposit_balance')} AS deposit_balance_million,
  {mil('total_loan_outstanding')} AS loan_outstanding_million, txn_count_30d, {mil('txn_amount_30d')} AS txn_amount_30d_million, m.days_since_last_txn,
  primary_channel, interaction_count_90d, last_interaction_date, rfm_recency_score, rfm_frequency_score, rfm_monetary_score, m.rfm_segment, churn_flag,
  cross_sell_credit_card_flag, campaign_type AS recommended_campaign
FROM g_mart m LEFT JOIN g_campaign c USING (customer_id) WHERE m.customer_id = 12""")
def customer_profile(lake: Lake) -> DataFrame:
    return business.customer_profile(lake.masked(), lake.gold("campaign_target"), 12)


def pct(column: str) -> str:
    return f"CAST(CAST((2000 * sum({column}) + count(*)) // (2 * count(*)) AS DECIMAL(12,0)) * 0.1 AS DECIMAL(18,1))"


@query("product_penetration", f"""
SELECT customer_segment, aum_bucket, count(*) AS total, {pct('has_credit_card')} AS pct_has_credit_card, {pct('has_savings')} AS pct_has_savings,
  {pct('has_loan')} AS pct_has_loan, nullif(count(*) FILTER (WHERE has_credit_card = 0), 0) AS opportunity_cc,
  nullif(count(*) FILTER (WHERE has_savings = 0), 0) AS opportunity_deposit, nullif(count(*) FILTER (WHERE has_loan = 0), 0) AS opportunity_loan,
  {mil('coalesce(sum(aum_total) FILTER (WHERE has_credit_card = 0), 0)', '0.000000001', 2)} AS cc_opportunity_aum_billion,
  nullif(count(*) FILTER (WHERE has_credit_card = 0 AND days_since_last_txn < 31), 0) AS cc_opportunity_active_30d,
  CAST(round(nullif(count(*) FILTER (WHERE has_credit_card = 0), 0) * 0.06, 1) AS DECIMAL(18,1)) AS estimated_fee_revenue_million_vnd
FROM g_mart GROUP BY ALL""")
def product_penetration(lake: Lake) -> DataFrame:
    return business.product_penetration(lake.masked())
