"""Two processing dates, a rerun, and a day that must be stopped."""

import dataclasses
import datetime as dt

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tellerflow.lake import SALT, SCD1, Lake
from tellerflow.operators import activity, asof, rolling, sinks
from tellerflow.plans import acceptance, marts
from tellerflow.plans.pipeline import Pipeline
from tellerflow.sources import bank


def test_two_days_and_a_rerun(spark, tmp_path):
    lake = Lake(spark, DATA)

    def feed(entity, day):
        base = lake.feed(entity)
        if entity in asof.FACTS:  # the last weeks are enough here; the registered query loads every day
            return base.where(F.col(asof.FACTS[entity].event) >= F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
        second = day > lake.base
        if entity in SCD1:
            return bank.scd1_day(base, *SCD1[entity], second)
        return bank.second_day(entity, base, deletes=broken) if second else base

    broken = False
    job = Pipeline(spark, str(tmp_path / "p"), feed, SALT)
    job.run(lake.base, "day-1", initial=True)
    job.run(lake.day, "day-2")
    prints = lambda: {n: tuple(sinks.fingerprint(df.drop("last_updated")).first()) for n, df in job.tables().items()}
    first = prints()
    job.run(lake.day, "day-2-again")
    assert prints() == first
    assert job.read("gold", "customer_360").select("cob_dt").distinct().count() == 2
    results = job.read("ops", "dq_result")
    assert results.count() == 57 and results.where("severity = 'critical' AND NOT passed").count() == 0
    assert acceptance.latest_status(job.read("ops", "run_log")).where("status <> 'S'").count() == 0

    # A past day arrives again without its events: the stored state follows without adding up its windows.
    src = activity.SOURCES["account"]
    late = job.read("silver", "fact_txn_account").where(F.col("cob_dt") < F.lit(lake.day)).agg(F.max("cob_dt")).first()[0]
    held = job.read("silver", "activity_account").where(F.col("cob_dt") == F.lit(lake.day)).agg(F.sum("n_cnt_365")).first()[0]
    gone = job.read("bronze", "txn_account").where(F.col("cob_dt") == F.lit(late)).count()
    assert gone > 0
    usual, job.feed = job.feed, lambda entity, day: feed(entity, day).where(F.col("txn_date").cast("date") != F.lit(late))
    job.correct("txn_account", [late], lake.day)
    job.feed = usual
    got = job.read("silver", "activity_account").where(F.col("cob_dt") == F.lit(lake.day))
    assert got.agg(F.sum("n_cnt_365")).first()[0] == held - gone
    want = rolling.state_of(job.read("silver", "activity_account_daily"), src.spec(), lake.day)
    assert sinks.fingerprint(got.select(*sorted(want.columns))).first() == sinks.fingerprint(want.select(*sorted(want.columns))).first()

    silver = job.silver()
    kept = marts.branch_monthly_summary(silver, lake.day)
    whole = marts.branch_monthly_summary(dataclasses.replace(silver, months=None), lake.day)
    assert kept.count() > 0 and sinks.fingerprint(kept).first() == sinks.fingerprint(whole).first()
    written = job.read("silver", "branch_month_state").where(F.col("cob_dt") == F.lit(lake.day)).where("n > 0").select("txn_year", "txn_month").distinct()
    assert {tuple(r) for r in written.collect()} <= {(d.year, d.month) for d in (late, lake.day)}

    broken = True  # keys with events of the day vanish: their events cannot be resolved and the gate stops the day
    with pytest.raises(RuntimeError, match="fact_surrogate_keys_not_orphan"):
        job.run(lake.day, "day-2-broken")
    last = acceptance.latest_status(job.read("ops", "run_log")).where("pipeline_run_id = 'day-2-broken' AND job_name = 'data_quality'").first()
    assert last.status == "F"
    assert job.read("ops", "dq_result").where("pipeline_run_id = 'day-2-broken'").count() == 19  # stored before the gate raised


def test_a_loaded_fact_is_shuffled_without_digits(spark, tmp_path, monkeypatch):
    """Rows are put in place with the start of the version; the stored keys are those of the stored dimension."""
    noon = dt.datetime(2024, 1, 5, 12)
    people = bank.customer(spark.createDataFrame([(k, f"Customer#{k}", k % 3, 10.0 * k, "AUTOMOBILE") for k in range(20)],
                                                 "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"))
    given = [(i, noon + dt.timedelta(days=i % 9), [None, 5, 900][i % 3] if i % 7 == 0 else i % 20, "view", float(i)) for i in range(90)]
    events = bank.card_txn(spark.createDataFrame(given, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"))
    job = Pipeline(spark, str(tmp_path / "p"), lambda entity, day: {"customer": people, "card_txn": events}[entity], SALT)
    kinds, usual = [], sinks.by_day
    monkeypatch.setattr(sinks, "by_day", lambda rows, key: kinds.append(dict(rows.dtypes).get("customer_sk")) or usual(rows, key))
    with sinks.scratch(spark, "t"):
        job.ingest("customer", bank.BASE_DAY, True)
        job.versioned("customer", bank.BASE_DAY)
        job.ingest("card_txn", bank.BASE_DAY, True)
        job.fact("card_txn", bank.BASE_DAY, True)
    assert kinds == [None, "date"]
    lookup = asof.Lookup(job.read("silver", "dim_customer"), "customer_id", "customer_sk")
    want = asof.resolve(job.read("bronze", "card_txn"), "txn_date", [lookup], bootstrap=True).drop("last_updated")
    got = job.read("silver", "fact_card_txn").select(want.columns)
    assert dict(got.dtypes)["customer_sk"] == "string" and 0 < got.where("customer_sk is null").count() < 90
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
