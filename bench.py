"""Time the headline queries; prints one JSON line.

Every timing builds its result from the stored silver or gold tables of a fresh
lake (``full_day`` also builds those tables) and writes it to the no-op sink.
Median of three runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tellerflow.lake import Lake
from tellerflow.operators import activity
from tellerflow.plans import business, dashboard, marts, quality
from tellerflow.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = local_session("tellerflow-bench", CPUS, partitions=CPUS)
    started = time.perf_counter()
    lake = Lake(spark, FOLDER)
    dict(lake.tables())  # bronze to serving, both processing dates
    full_day = time.perf_counter() - started

    silver, day = lake.silver(), lake.day
    masked, dash = lake.masked(), lake.dashboard()
    headline = {
        "account_activity": lambda: activity.account_activity(silver.fact_txn_account, day),
        "card_activity": lambda: activity.card_activity(silver.fact_card_txn, day),
        "customer_balance_summary": lambda: marts.balance_summary(silver, day),
        "customer_transaction_summary": lambda: marts.transaction_summary(silver, day),
        "mart_customer_360_history": lambda: marts.customer_360(silver, day),
        "rfm_segment": lambda: marts.rfm_segment(silver, day),
        "churn_prediction": lambda: marts.churn_prediction(silver, day),
        "campaign_target": lambda: lake.mart_plan("campaign_target", day),
        "branch_monthly_summary": lambda: marts.branch_monthly_summary(silver, day, bootstrap=True),
        "scd2_apply": lambda: lake.versions("account"),
        "fact_resolve_initial": lambda: lake.fact_initial("txn_account"),
        "fact_resolve_daily": lambda: lake.fact_daily("txn_account"),
        "cross_sell_credit_card": lambda: business.cross_sell_credit_card(masked, "B01"),
        "churn_risk_customers": lambda: business.churn_risk_customers(masked, lake.gold("churn_prediction")),
        "rfm_segment_distribution": lambda: business.rfm_segment_distribution(masked),
        "aum_by_branch": lambda: business.aum_by_branch(masked),
        "customer_profile": lambda: business.customer_profile(masked, lake.gold("campaign_target"), 12),
        "product_penetration": lambda: business.product_penetration(masked),
        "dash_kpis": lambda: dashboard.kpis(dash),
        "dq_run_checks": lambda: quality.check_frame(quality.CHECKS, lake.tables(), day),
    }
    seconds = {"full_day": round(full_day, 3)}
    for name, build in headline.items():
        timings = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
