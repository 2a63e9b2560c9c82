"""Each check passes on sound tables and fails on a table broken for it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.plans import quality, serving
from tellerflow.plans.quality import CHECKS, Check

col, lit = F.col, F.lit
BY_NAME = {c.name: c for c in CHECKS}


@pytest.fixture(scope="module")
def tables(lake):
    """Sound tables: facts without the events of keys the second day deleted."""
    t = dict(lake.tables())
    t["fact_txn_account"] = t["fact_txn_account"].where("account_sk IS NOT NULL AND customer_sk IS NOT NULL")
    for name in ("fact_card_txn", "fact_crm_interaction"):
        t[name] = t[name].where("customer_sk IS NOT NULL")
    return t


def twice(df):
    return df.unionByName(df)


BREAK = {
    "mart_customer_360_current_contract": ("mart_customer_360", lambda df: df.withColumn("cob_dt", lit(dt.date(2024, 1, 1)))),
    "scd2_single_current_row": ("dim_account", lambda df: df.withColumn("is_current", lit(1))),
    "scd2_no_effective_range_overlap": ("dim_branch", twice),
    "scd2_valid_ranges_and_current_expiry": ("dim_product", lambda df: df.withColumn("effective_to", lit(dt.date(2000, 1, 1)))),
    "fact_surrogate_keys_not_orphan": ("fact_card_txn", lambda df: df.withColumn("customer_sk", lit(None).cast("string"))),
    "business_flags_are_binary": ("churn_prediction", lambda df: df.withColumn("is_churn_candidate", lit(2))),
    "rfm_scores_in_valid_range": ("rfm_segment", lambda df: df.withColumn("r_score", lit(6))),
    "campaign_unique_customer_date": ("campaign_target", twice),
    "nbo_contract_is_valid": ("campaign_target", lambda df: df.withColumn("suppression_reason", lit("x"))),
    "segmentation_population_matches_current": ("rfm_segment", lambda df: df.where("customer_id % 2 = 0")),
    "gold_customer_population_matches_silver": ("mart_customer_360", lambda df: df.where("customer_id % 2 = 0")),
    "aum_reconciles_to_independent_sources": ("mart_customer_360", lambda df: df.withColumn("aum_total", (col("aum_total") + 1).cast("decimal(18,2)"))),
    "masked_mart_matches_gold_current": ("mart_customer_360_masked", lambda df: df.where("customer_id <> 12")),
    "masked_mart_has_no_raw_pii_columns": ("mart_customer_360_masked", lambda df: df.withColumn("Phone", lit("1"))),
    "dashboard_customer_date_is_unique": ("mart_customer_360_dashboard", twice),
    "dashboard_population_matches_gold_history": ("mart_customer_360_dashboard", lambda df: df.where("customer_id <> 12")),
    "dashboard_nbo_contract_is_valid": ("mart_customer_360_dashboard", lambda df: df.withColumn("cross_sell_score", lit(101))),
    "dashboard_has_no_raw_pii_columns": ("mart_customer_360_dashboard", lambda df: df.withColumn("cccd", lit("1"))),
    "all_rfm_segments_reachable": ("rfm_segment", lambda df: df.withColumn("rfm_segment", lit("Lost"))),
}


@pytest.mark.parametrize("name", list(BREAK))
def test_check_passes_and_fails(lake, tables, name):
    check = BY_NAME[name].validate()
    failed = lambda t: check.run(t, lake.day).first().failed_count
    assert failed(tables) == 0
    table, harm = BREAK[name]
    assert failed({**tables, table: harm(tables[table])}) > 0


def test_populated_checks_fail_on_empty_tables(lake, tables):
    for name, table in (("nbo_contract_is_valid", "campaign_target"), ("rfm_scores_in_valid_range", "rfm_segment"),
                        ("campaign_unique_customer_date", "campaign_target"), ("mart_customer_360_current_contract", "mart_customer_360")):
        empty = {**tables, table: tables[table].limit(0)}
        assert BY_NAME[name].run(empty, lake.day).first().failed_count == 1


def test_runner_and_gate(spark, lake, tables):
    broken = Check("broken", "gold", "x", "range", lambda t, d: t["no such table"])
    warned = Check("warned", "gold", "x", "range", lambda t, d: spark.range(1).selectExpr("3 AS failed_count", "4 AS total_count"), severity="warning")
    results = quality.run_checks([broken, warned], tables, lake.day, "p", "q")
    assert [(r["failed_count"], r["passed"]) for r in results] == [(-1, False), (3, False)]
    assert "KeyError" in results[0]["error_detail"]
    assert S.assert_schema(quality.result_frame(spark, results), S.DQ_RESULT_TABLE).count() == 2
    quality.gate(results[1:])  # a warning never raises
    with pytest.raises(RuntimeError, match="broken"):
        quality.gate(results)


def test_dashboard_publish_guard(lake, tmp_path):
    dash, path = lake.dashboard(), str(tmp_path / "dash")
    for bad, message in ((dash.limit(0), "empty"), (twice(dash), "grain"), (dash.withColumn("campaign_priority", lit("URGENT")), "invalid offers")):
        with pytest.raises(RuntimeError, match=message):
            serving.publish_dashboard(bad, path, lake.day)
    assert serving.publish_dashboard(dash, path, lake.day) == dash.count()
