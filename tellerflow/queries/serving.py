"""Masking and serving (SV)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions import columns as C
from tellerflow.lake import SALT, Lake
from tellerflow.plans import quality, serving
from tellerflow.queries.dataquality import _texts
from tellerflow.queries.oracle import D, raw_values
from tellerflow.queries.registry import query

_FULL = """CASE len(string_split(full_name, ' ')) WHEN 1 THEN full_name[1] || '**'
  WHEN 2 THEN regexp_replace(full_name, '^(\\S+) (\\S).*$', '\\1 \\2**')
  ELSE regexp_replace(full_name, '^(\\S+) (\\S).* (\\S)\\S*$', '\\1 \\2** \\3**') END"""
_PHONE = "substr(phone, 1, 3) || '****' || substr(phone, 8)"
_EMAIL = "email[1] || '*****' || split_part(email, '@', 1)[-1] || '@' || split_part(email, '@', 2)"


@query("mask_name_full", f"SELECT customer_id, {_FULL} AS full_name_masked FROM e_customer")
def mask_name_full(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.mask_name_full(F.col("full_name")).alias("full_name_masked"))


@query("mask_name_short", "SELECT customer_id, split_part(full_name, ' ', 1) || ' **' AS full_name_masked FROM e_customer")
def mask_name_short(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.mask_name_short(F.col("full_name")).alias("full_name_masked"))


@query("mask_phone", f"SELECT customer_id, {_PHONE} AS phone_masked FROM e_customer")
def mask_phone(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.mask_phone(F.col("phone")).alias("phone_masked"))


@query("mask_email", f"SELECT customer_id, {_EMAIL} AS email_masked FROM e_customer")
def mask_email(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.mask_email(F.col("email")).alias("email_masked"))


@query("hash_national_id", f"SELECT customer_id, sha256(cccd || '{SALT}') AS cccd_hash FROM e_customer")
def hash_national_id(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.hash_national_id(F.col("cccd"), SALT).alias("cccd_hash"))


@query("generalize_age_address", f"SELECT customer_id, date_diff('day', date_of_birth, DATE '{D}') // 3650 * 10 AS age_group_decade, city, district FROM e_customer")
def generalize_age_address(lake: Lake) -> DataFrame:
    decade = C.birth_decade(F.col("date_of_birth"), lake.day)
    return lake.feed("customer").select("customer_id", decade.alias("age_group_decade"), "city", "district")


_MASKED = f"""
SELECT customer_sk, customer_id, {_FULL} AS full_name_masked, gender, date_diff('day', date_of_birth, DATE '{D}') // 3650 * 10 AS age_group_decade,
  {_PHONE} AS phone_masked, {_EMAIL} AS email_masked, sha256(cccd || '{SALT}') AS cccd_hash, city, district, branch_code, customer_segment, kyc_status,
  register_date, is_active, effective_from, effective_to, is_current, last_updated FROM d_customer"""


@query("dim_customer_masked", _MASKED)
def dim_customer_masked(lake: Lake) -> DataFrame:
    return serving.customer_masked(lake.dim("customer"), lake.day, SALT)


@query("mart_customer_360_masked", "SELECT * FROM g_mart")
def mart_customer_360_masked(lake: Lake) -> DataFrame:
    return serving.mart_masked(lake.mart())


@query("dashboard_mart", "SELECT * FROM s_dash")
def dashboard_mart(lake: Lake) -> DataFrame:
    """Published through the guard, then read back."""
    rows = serving.dashboard_mart(lake.gold("customer_360"), lake.gold("campaign_target"), lake.day)
    path = f"{lake.root}/published-dashboard"
    serving.publish_dashboard(rows, path, lake.day)
    return lake.spark.read.schema(S.DASHBOARD_360.struct).parquet(path)


_SHOWN = {
    "dim_customer": ("d_customer", _texts(S.CUSTOMER), 5),
    "mart_customer_360_masked": ("g_mart", _texts(S.MART_360.ddl), 0),
    "mart_customer_360_dashboard": ("s_dash", _texts(S.DASHBOARD_360.ddl), 0),
    "dim_customer_masked": (f"({_MASKED})", "full_name_masked gender phone_masked email_masked cccd_hash city district branch_code customer_segment kyc_status".split(), 0),
}


@query("assert_no_pii_columns", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {exposed} + {raw_values(view, texts)} AS failed_count, (SELECT count(*) FROM {view}) AS total_count"
    for name, (view, texts, exposed) in _SHOWN.items()))
def assert_no_pii_columns(lake: Lake) -> DataFrame:
    """Exposed columns and rows with raw values; the unmasked dimension itself shows what the check finds."""
    frames = {
        "dim_customer": lake.dim("customer"), "mart_customer_360_masked": lake.masked(), "mart_customer_360_dashboard": lake.dashboard(),
        "dim_customer_masked": serving.customer_masked(lake.dim("customer"), lake.day, SALT),
    }
    rows = None
    for name, df in frames.items():
        one = quality.pii_check(df, lake.dim("customer"), lake.day).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows
