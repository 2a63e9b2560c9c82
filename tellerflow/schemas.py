"""Declared table schemas, keys and partition columns (the output contract)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """One declared table: columns as DDL text, key columns, partition column."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    partition: str | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.struct.names


# Column names and types are the data contract of the model.
BRANCH = """branch_code STRING, branch_name STRING, region STRING, city STRING, district STRING, address STRING,
  manager_name STRING, open_date DATE, status STRING, last_updated TIMESTAMP_NTZ"""
PRODUCT = """product_code STRING, product_name STRING, product_group STRING, product_type STRING, currency STRING,
  is_active INT, launch_date DATE, last_updated TIMESTAMP_NTZ"""
CUSTOMER = """customer_id BIGINT, cccd STRING, full_name STRING, gender STRING, date_of_birth DATE, phone STRING,
  email STRING, address STRING, city STRING, district STRING, branch_code STRING, customer_segment STRING,
  kyc_status STRING, register_date DATE, is_active INT, last_updated TIMESTAMP_NTZ"""
ACCOUNT = """account_id BIGINT, account_no STRING, customer_id BIGINT, product_code STRING, branch_code STRING,
  account_type STRING, currency STRING, balance DECIMAL(18,2), open_date DATE, close_date DATE, status STRING,
  last_updated TIMESTAMP_NTZ"""
DEPOSIT = """deposit_id BIGINT, account_id BIGINT, customer_id BIGINT, product_code STRING,
  principal_amount DECIMAL(18,2), interest_rate DECIMAL(5,2), term_months INT, open_date DATE, maturity_date DATE,
  status STRING, last_updated TIMESTAMP_NTZ"""
LOAN = """loan_id BIGINT, customer_id BIGINT, product_code STRING, branch_code STRING, loan_amount DECIMAL(18,2),
  outstanding_balance DECIMAL(18,2), interest_rate DECIMAL(5,2), term_months INT, disbursement_date DATE,
  maturity_date DATE, loan_status STRING, last_updated TIMESTAMP_NTZ"""
CARD = """card_id BIGINT, card_no_masked STRING, customer_id BIGINT, account_id BIGINT, product_code STRING,
  card_type STRING, card_brand STRING, credit_limit DECIMAL(18,2), issue_date DATE, expiry_date DATE, status STRING,
  last_updated TIMESTAMP_NTZ"""
TXN_ACCOUNT = """txn_id STRING, account_id BIGINT, customer_id BIGINT, txn_date TIMESTAMP_NTZ,
  txn_amount DECIMAL(18,2), txn_type STRING, debit_credit STRING, balance_after DECIMAL(18,2), channel STRING,
  description STRING, counter_account STRING, created_ts TIMESTAMP_NTZ, last_updated TIMESTAMP_NTZ"""
CARD_TXN = """txn_id BIGINT, card_id BIGINT, customer_id BIGINT, txn_date TIMESTAMP_NTZ, txn_amount DECIMAL(18,2),
  txn_type STRING, currency STRING, merchant_name STRING, merchant_category STRING, channel STRING, status STRING,
  created_ts TIMESTAMP_NTZ, last_updated TIMESTAMP_NTZ"""
CRM = """interaction_id BIGINT, customer_id BIGINT, interaction_date TIMESTAMP_NTZ, channel STRING,
  direction STRING, subject STRING, category STRING, status STRING, assigned_to STRING, created_ts TIMESTAMP_NTZ,
  last_updated TIMESTAMP_NTZ"""
MART = """customer_id BIGINT, customer_sk STRING, full_name_masked STRING, age INT, gender STRING,
  primary_branch_code STRING, customer_segment STRING, kyc_status STRING, register_date DATE, total_accounts INT,
  total_cards INT, total_loans INT, has_credit_card INT, has_savings INT, has_loan INT,
  total_deposit_balance DECIMAL(18,2), total_loan_outstanding DECIMAL(18,2), aum_total DECIMAL(18,2),
  aum_bucket STRING, txn_count_30d BIGINT, txn_amount_30d DECIMAL(18,2), last_txn_date TIMESTAMP_NTZ,
  days_since_last_txn INT, primary_channel STRING, interaction_count_90d BIGINT,
  last_interaction_date TIMESTAMP_NTZ, rfm_recency_score INT, rfm_frequency_score INT, rfm_monetary_score INT,
  rfm_segment STRING, churn_flag INT, cross_sell_credit_card_flag INT, cob_dt DATE"""
DASHBOARD = """customer_id BIGINT, customer_sk STRING, full_name_masked STRING, age INT, age_group STRING,
  gender STRING, primary_branch_code STRING, customer_segment STRING, kyc_status STRING, register_date DATE,
  total_accounts INT, total_cards INT, total_loans INT, has_credit_card INT, has_savings INT, has_loan INT,
  total_deposit_balance DECIMAL(18,2), total_loan_outstanding DECIMAL(18,2), aum_total DECIMAL(18,2),
  aum_bucket STRING, txn_count_30d BIGINT, txn_amount_30d DECIMAL(18,2), last_txn_date TIMESTAMP_NTZ,
  days_since_last_txn INT, primary_channel STRING, interaction_count_90d BIGINT,
  last_interaction_date TIMESTAMP_NTZ, rfm_recency_score INT, rfm_frequency_score INT, rfm_monetary_score INT,
  rfm_segment STRING, churn_flag INT, churn_risk STRING, is_churn_candidate INT, cross_sell_credit_card_flag INT,
  no_credit_card INT, no_deposit INT, no_loan INT, cross_sell_score INT, recommended_product STRING,
  recommendation_reason STRING, campaign_priority STRING, contact_eligible_flag INT, suppression_reason STRING,
  campaign_type STRING, cob_dt DATE"""
RUN_LOG = """id BIGINT, job_name STRING, schema_name STRING, table_name STRING, status STRING,
  start_time TIMESTAMP, end_time TIMESTAMP, cob_dt DATE, dag_run_id STRING, pipeline_run_id STRING,
  try_number INT, error_detail STRING, created_at TIMESTAMP"""
DQ_RESULT = """check_name STRING, table_name STRING, schema_name STRING, cob_dt DATE, pipeline_run_id STRING,
  dq_run_id STRING, severity STRING, check_type STRING, passed BOOLEAN, failed_count BIGINT, total_count BIGINT,
  error_detail STRING, executed_at TIMESTAMP"""

# Columns of the gold tables, after customer_id and customer_sk and before cob_dt where they have these.
PER_CUSTOMER = {
    "balance_summary": """total_account_balance DECIMAL(18,2), avg_account_balance DECIMAL(18,2), total_deposit_principal DECIMAL(18,2),
  total_loan_outstanding DECIMAL(18,2), aum_total DECIMAL(18,2), net_worth DECIMAL(18,2)""",
    "product_summary": """total_accounts INT, cnt_casa_active INT, cnt_td_active INT, cnt_deposits INT, cnt_deposits_active INT,
  cnt_loans INT, cnt_loans_active INT, cnt_cards INT, cnt_credit_cards INT, cnt_debit_cards INT, has_credit_card INT,
  has_savings INT, has_loan INT""",
    "card_summary": """total_cards INT, cnt_credit_active INT, cnt_debit_active INT, max_credit_limit DECIMAL(18,2),
  total_card_txn_count_30d BIGINT, total_card_txn_amount_30d DECIMAL(18,2), avg_card_txn_amount_30d DECIMAL(18,2),
  distinct_merchant_categories INT, last_card_txn_date TIMESTAMP_NTZ""",
    "transaction_summary": """acct_txn_count_30d BIGINT, acct_txn_amount_30d DECIMAL(18,2), acct_credit_count_30d BIGINT,
  acct_debit_count_30d BIGINT, acct_credit_amount_30d DECIMAL(18,2), acct_debit_amount_30d DECIMAL(18,2),
  card_txn_count_30d BIGINT, card_txn_amount_30d DECIMAL(18,2), total_txn_count_30d BIGINT,
  total_txn_amount_30d DECIMAL(18,2), last_txn_date TIMESTAMP_NTZ""",
    "rfm_segment": """recency_days INT, frequency BIGINT, monetary DECIMAL(18,2), r_score INT, f_score INT, m_score INT,
  rfm_score INT, rfm_segment STRING""",
    "churn_prediction": """txn_cnt_30d BIGINT, txn_cnt_90d BIGINT, txn_amt_30d DECIMAL(18,2), txn_amt_90d DECIMAL(18,2),
  days_since_last_txn INT, churn_risk STRING, is_churn_candidate INT""",
    "cross_sell_segment": """customer_segment STRING, no_credit_card INT, no_deposit INT, no_loan INT, primary_opportunity STRING""",
    "campaign_target": """rfm_segment STRING, rfm_score INT, recency_days INT, frequency BIGINT, monetary DECIMAL(18,2),
  churn_risk STRING, is_churn_candidate INT, days_since_last_txn INT, customer_segment STRING, aum_total DECIMAL(18,2),
  aum_bucket STRING, primary_branch_code STRING, primary_opportunity STRING, no_credit_card INT, no_deposit INT, no_loan INT,
  cross_sell_score INT, recommended_product STRING, recommendation_reason STRING, campaign_priority STRING,
  contact_eligible_flag INT, suppression_reason STRING, campaign_type STRING""",
}
BRANCH_MONTHS = """branch_code STRING, branch_name STRING, region STRING, city STRING, txn_year INT, txn_month INT,
  txn_quarter INT, active_customers BIGINT, txn_count BIGINT, total_txn_amount DECIMAL(18,2), avg_txn_amount DECIMAL(18,2),
  total_credit_amount DECIMAL(18,2), total_debit_amount DECIMAL(18,2), top_channel STRING, cob_dt DATE"""
CUSTOMER_MASKED = """customer_sk STRING, customer_id BIGINT, full_name_masked STRING, gender STRING, age_group_decade INT,
  phone_masked STRING, email_masked STRING, cccd_hash STRING, city STRING, district STRING, branch_code STRING,
  customer_segment STRING, kyc_status STRING, register_date DATE, is_active INT, effective_from DATE, effective_to DATE,
  is_current INT, last_updated TIMESTAMP_NTZ"""
VERSION = "effective_from DATE, effective_to DATE, is_current INT"

FEEDS = {
    "branch": Table("branch", BRANCH, ("branch_code",)),
    "product": Table("product", PRODUCT, ("product_code",)),
    "customer": Table("customer", CUSTOMER, ("customer_id",)),
    "account": Table("account", ACCOUNT, ("account_id",)),
    "deposit": Table("deposit", DEPOSIT, ("deposit_id",)),
    "loan": Table("loan", LOAN, ("loan_id",)),
    "card": Table("card", CARD, ("card_id",)),
    "txn_account": Table("txn_account", TXN_ACCOUNT, ("txn_id",)),
    "card_txn": Table("card_txn", CARD_TXN, ("txn_id",)),
    "crm_interaction": Table("crm_interaction", CRM, ("interaction_id",)),
}
MART_360 = Table("mart_customer_360_history", MART, ("customer_id", "cob_dt"), "cob_dt")
DASHBOARD_360 = Table("mart_customer_360_dashboard", DASHBOARD, ("customer_id", "cob_dt"), "cob_dt")


def _fact(name: str, feed: str, key: str, *dimensions: str) -> Table:
    """A fact has its feed's columns without the technical date, its own date, and the versions it belongs to."""
    kept = re.sub(r",\s*last_updated TIMESTAMP_NTZ", "", FEEDS[feed].ddl)
    return Table(name, ", ".join([kept, "cob_dt DATE", *(f"{d}_sk STRING" for d in dimensions)]), (key,), "cob_dt")


TABLES = {
    **{f"dim_{e}": Table(f"dim_{e}", f"{FEEDS[e].ddl}, {VERSION}, {e}_sk STRING", (f"{e}_sk",), "effective_to") for e in ("branch", "product", "customer", "account")},
    **{f"dim_{e}": Table(f"dim_{e}", FEEDS[e].ddl, FEEDS[e].keys) for e in ("deposit", "loan", "card")},
    "fact_txn_account": _fact("fact_txn_account", "txn_account", "txn_id", "account", "customer"),
    "fact_card_txn": _fact("fact_card_txn", "card_txn", "txn_id", "customer"),
    "fact_crm_interaction": _fact("fact_crm_interaction", "crm_interaction", "interaction_id", "customer"),
    **{n: Table(n, f"customer_id BIGINT, customer_sk STRING, {c}, cob_dt DATE", ("customer_id", "cob_dt"), "cob_dt") for n, c in PER_CUSTOMER.items()},
    "branch_monthly_summary": Table("branch_monthly_summary", BRANCH_MONTHS, ("branch_code", "txn_year", "txn_month", "cob_dt"), "cob_dt"),
    "customer_360": MART_360,
    "mart_customer_360": Table("mart_customer_360", MART, ("customer_id",)),
    "mart_customer_360_masked": Table("mart_customer_360_masked", MART, ("customer_id",)),
    "dim_customer_masked": Table("dim_customer_masked", CUSTOMER_MASKED, ("customer_sk",)),
    "mart_customer_360_dashboard": DASHBOARD_360,
}
RUN_LOG_TABLE = Table("run_log", RUN_LOG, ("id",))
DQ_RESULT_TABLE = Table("dq_result", DQ_RESULT, ("dq_run_id", "check_name"))

PII_COLUMNS = ("full_name", "phone", "email", "cccd", "address")
PII_VALUES = ("full_name", "phone", "email", "cccd")  # what identifies a customer wherever it is shown


def assert_schema(df: DataFrame, table: Table) -> DataFrame:
    """Refuse a frame whose columns or types differ from the declared table; order columns as declared."""
    want = {field.name: field.dataType.simpleString() for field in table.struct}
    have = {field.name: field.dataType.simpleString() for field in df.schema}
    missing = sorted(set(want) - set(have))
    unexpected = sorted(set(have) - set(want))
    changed = sorted(c for c in set(want) & set(have) if want[c] != have[c])
    if missing or unexpected or changed:
        raise ValueError(
            f"{table.name}: schema differs; missing={missing}, unexpected={unexpected}, "
            f"types={[(c, have[c], want[c]) for c in changed]}"
        )
    return df.select(*want)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast and order the declared columns of a feed."""
    fields = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def exposed_pii(df: DataFrame, forbidden: tuple[str, ...] = PII_COLUMNS) -> list[str]:
    """Forbidden raw columns present in a serving frame, case-insensitively."""
    return sorted({c.lower() for c in df.columns} & {c.lower() for c in forbidden})
