"""History and fact operators (HS) over the two daily snapshots."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.lake import Lake
from tellerflow.operators import asof, history
from tellerflow.operators.history import DIMENSIONS
from tellerflow.queries.oracle import COLUMNS, D, OPEN, P
from tellerflow.queries.registry import query

col, lit = F.col, F.lit


def _diff(entity: str, a: str, b: str) -> str:
    cols = COLUMNS[entity][1:-1]
    return f"({', '.join(f'{a}.{c}' for c in cols)}) IS DISTINCT FROM ({', '.join(f'{b}.{c}' for c in cols)})"


@query("scd1_upsert", "SELECT * FROM d_card")
def scd1_upsert(lake: Lake) -> DataFrame:
    return history.scd1_upsert(lake.snapshot("card", lake.base), lake.snapshot("card", lake.day), ["card_id"])


@query("scd2_classify", f"""
SELECT coalesce(b.customer_id, s.customer_id) AS customer_id, CASE WHEN b.customer_id IS NULL THEN 'new' WHEN s.customer_id IS NULL THEN 'deleted'
  WHEN {_diff('customer', 'b', 's')} THEN 'changed' ELSE 'unchanged' END AS change
FROM e_customer b FULL JOIN e_customer_next s ON b.customer_id = s.customer_id""")
def scd2_classify(lake: Lake) -> DataFrame:
    return history.classify(lake.baseline("customer"), lake.snapshot("customer", lake.day), DIMENSIONS["customer"]).select("customer_id", "change")


@query("scd2_apply", "SELECT * FROM d_account")
def scd2_apply(lake: Lake) -> DataFrame:
    return lake.versions("account")


@query("scd2_detect_deletes", f"""
SELECT customer_id, customer_sk, effective_to FROM d_customer WHERE customer_id NOT IN (SELECT customer_id FROM e_customer_next)""")
def scd2_detect_deletes(lake: Lake) -> DataFrame:
    versions = lake.versions("customer")
    gone = versions.join(lake.snapshot("customer", lake.day), "customer_id", "left_anti")
    return gone.where(col("is_current") == 0).select("customer_id", "customer_sk", "effective_to")


@query("scd2_rerun_recover", f"""
SELECT b.*, DATE '{P}' AS effective_from, CASE WHEN s.account_id IS NULL THEN DATE '{P}' ELSE {OPEN} END AS effective_to,
  CASE WHEN s.account_id IS NULL THEN 0 ELSE 1 END AS is_current, sha256(b.account_id || '|{P}') AS account_sk
FROM e_account b LEFT JOIN e_account_next s USING (account_id)""")
def scd2_rerun_recover(lake: Lake) -> DataFrame:
    """The state before the day's run again; keys the earlier attempt deleted stay closed, as no version marks them."""
    return history.recover(lake.dim("account"), DIMENSIONS["account"], lake.day)


@query("scd2_source_guard", """
SELECT o_custkey AS customer_id, count(*) AS row_count, 'duplicate_key' AS problem FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def scd2_source_guard(lake: Lake) -> DataFrame:
    """What the guard would refuse if orders were delivered as a customer snapshot."""
    wrong = lake.raw("orders").select(col("o_custkey").alias("customer_id"))
    return history.source_problems(wrong, DIMENSIONS["customer"])


@query("scd2_backdate_guard", f"""
SELECT count(*) FILTER (WHERE effective_from > DATE '{P}') AS later_versions, max(effective_from) AS latest_effective_from FROM d_customer""")
def scd2_backdate_guard(lake: Lake) -> DataFrame:
    return history.backdated_rows(lake.dim("customer"), lake.base)


# a history with known faults: every version of some keys made current, some ends moved
_BROKEN = f"""
(SELECT * REPLACE (CASE WHEN account_id % 7 = 0 THEN 1 ELSE is_current END AS is_current,
  CASE WHEN is_current = 0 AND account_id % 4 = 1 THEN effective_to + 1 WHEN account_id % 50 = 3 THEN DATE '2000-01-01' ELSE effective_to END AS effective_to,
  CASE WHEN account_id % 31 = 0 THEN 'x' ELSE account_sk END AS account_sk) FROM d_account)"""


def _violations(table: str) -> str:
    return f"""
SELECT count(*) FILTER (WHERE account_id IS NULL OR account_sk IS NULL OR effective_from IS NULL OR effective_to IS NULL OR is_current IS NULL) AS null_metadata,
  count(*) FILTER (WHERE is_current NOT IN (0, 1)) AS invalid_flag, count(*) FILTER (WHERE effective_from > effective_to) AS inverted_range,
  count(*) FILTER (WHERE (is_current = 1) <> (effective_to = {OPEN})) AS sentinel_mismatch,
  (SELECT count(*) FROM (SELECT account_sk FROM {table} GROUP BY account_sk HAVING count(*) > 1)) AS duplicate_sk,
  (SELECT count(*) FROM (SELECT account_id FROM {table} WHERE is_current = 1 GROUP BY account_id HAVING count(*) > 1)) AS multiple_current,
  (SELECT count(*) FROM (SELECT effective_from, lag(effective_to) OVER (PARTITION BY account_id ORDER BY effective_from, effective_to, account_sk) AS p FROM {table})
    WHERE effective_from <= p) AS overlapping_ranges
FROM {table}"""


@query("scd2_history_check", f"SELECT 'sound' AS case_name, * FROM ({_violations('d_account')}) UNION ALL SELECT 'broken', * FROM ({_violations(_BROKEN)})")
def scd2_history_check(lake: Lake) -> DataFrame:
    spec, sound, key = DIMENSIONS["account"], lake.dim("account"), col("account_id")
    stop = col("effective_to")
    broken = sound.select(
        *[c for c in sound.columns if c not in ("is_current", "effective_to", "account_sk")],
        F.when(key % 7 == 0, lit(1)).otherwise(col("is_current")).alias("is_current"),
        F.when((col("is_current") == 0) & (key % 4 == 1), F.date_add(stop, 1))
        .when(key % 50 == 3, lit(dt.date(2000, 1, 1))).otherwise(stop).alias("effective_to"),
        F.when(key % 31 == 0, lit("x")).otherwise(col("account_sk")).alias("account_sk"),
    )
    parts = [history.history_violations(df, spec).withColumn("case_name", lit(n)) for n, df in (("sound", sound), ("broken", broken))]
    return parts[0].unionByName(parts[1])


@query("scd2_source_sync_check", f"""
SELECT 'after_run' AS case_name, 0 AS missing_current, 0 AS deleted_still_current, 0 AS value_mismatch UNION ALL
SELECT 'before_run', (SELECT count(*) FROM e_account_next WHERE account_id NOT IN (SELECT account_id FROM e_account)),
  (SELECT count(*) FROM e_account WHERE account_id NOT IN (SELECT account_id FROM e_account_next)),
  (SELECT count(*) FROM e_account b JOIN e_account_next s USING (account_id) WHERE {_diff('account', 'b', 's')})""")
def scd2_source_sync_check(lake: Lake) -> DataFrame:
    spec, snapshot = DIMENSIONS["account"], lake.snapshot("account", lake.day)
    after = history.sync_violations(lake.dim("account"), snapshot, spec).withColumn("case_name", lit("after_run"))
    before = history.sync_violations(lake.baseline("account"), snapshot, spec).withColumn("case_name", lit("before_run"))
    return after.unionByName(before)


@query("fact_resolve_daily", f"SELECT * FROM f_acct WHERE cob_dt = DATE '{D}'")
def fact_resolve_daily(lake: Lake) -> DataFrame:
    return lake.fact_daily("txn_account")


@query("fact_resolve_initial", f"SELECT * FROM f_acct WHERE cob_dt < DATE '{D}'")
def fact_resolve_initial(lake: Lake) -> DataFrame:
    return lake.fact_initial("txn_account")


_CONTRACT = """
SELECT '{n}' AS fact, count(*) AS row_count, count(*) FILTER (WHERE cob_dt IS NULL) AS null_partition, 0 AS outside_day, 0 AS misdated,
  (SELECT count(*) FROM (SELECT 1 FROM {v} GROUP BY {k} HAVING count(*) > 1)) AS duplicate_keys FROM {v}"""


@query("fact_output_contract", " UNION ALL ".join(_CONTRACT.format(n=n, v=v, k=k) for n, v, k in (
    ("fact_txn_account", "f_acct", "txn_id"), ("fact_card_txn", "f_card", "txn_id"), ("fact_crm_interaction", "f_crm", "interaction_id"))))
def fact_output_contract(lake: Lake) -> DataFrame:
    parts = [asof.contract_counts(lake.fact(f), spec).withColumn("fact", lit(spec.name)) for f, spec in asof.FACTS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("controlled_day2_changes", "SELECT * FROM e_account_next")
def controlled_day2_changes(lake: Lake) -> DataFrame:
    return lake.snapshot("account", lake.day)


def _shown(entity: str, values: list[str]) -> str:
    parts = " || '; ' || ".join(f"'{v}=' || coalesce(CAST({v} AS VARCHAR), '')" for v in values)
    return (
        f"SELECT 'dim_{entity}' AS table_name, CAST({COLUMNS[entity][0]} AS VARCHAR) AS business_key, {entity}_sk AS surrogate_key, effective_from, "
        f"effective_to, is_current, {parts} AS business_values FROM d_{entity}"
    )


@query("history_of_key", _shown("customer", ["phone", "address", "customer_segment"]) + " WHERE customer_id IN (11, 21, 34, 26)")
def history_of_key(lake: Lake) -> DataFrame:
    return history.history_of_keys(lake.dim("customer"), DIMENSIONS["customer"], [11, 21, 34, 26], ["phone", "address", "customer_segment"])
