"""Gold marts (MT) of the processing date, built from the stored silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tellerflow.lake import Lake
from tellerflow.plans import marts, serving
from tellerflow.queries.registry import query

_MARTS = {
    "customer_balance_summary": ("balance_summary", "g_balance"),
    "customer_product_summary": ("product_summary", "g_product"),
    "customer_card_summary": ("card_summary", "g_card"),
    "customer_transaction_summary": ("transaction_summary", "g_txn"),
    "mart_customer_360_history": ("customer_360", "g_mart"),
    "rfm_segment": ("rfm_segment", "g_rfm"),
    "churn_prediction": ("churn_prediction", "g_churn"),
    "cross_sell_segment": ("cross_sell_segment", "g_cross"),
    "campaign_target": ("campaign_target", "g_campaign"),
    "branch_monthly_summary": ("branch_monthly_summary", "g_branch"),
}


def _register(name: str, plan: str, view: str) -> None:
    @query(name, f"SELECT * FROM {view}")
    def run(lake: Lake) -> DataFrame:
        return lake.mart_plan(plan, lake.day)


for _name, (_plan, _view) in _MARTS.items():
    _register(_name, _plan, _view)


@query("branch_monthly_summary_bootstrap", "SELECT * FROM g_branch_all")
def branch_months_of_all_events(lake: Lake) -> DataFrame:
    """Each account's first version also covers what came before it, so every event counts."""
    return marts.branch_monthly_summary(lake.silver(), lake.day, bootstrap=True)


@query("mart_customer_360_current", "SELECT * FROM gg_mart WHERE cob_dt = (SELECT max(cob_dt) FROM gg_mart)")
def mart_current(lake: Lake) -> DataFrame:
    return serving.current_mart(lake.gold("customer_360"), lake.day)
