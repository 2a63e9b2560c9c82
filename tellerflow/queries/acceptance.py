"""Acceptance queries (AC)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.lake import Lake
from tellerflow.operators import activity as A
from tellerflow.operators import asof, history, sinks
from tellerflow.operators.history import DIMENSIONS
from tellerflow.plans import acceptance as R
from tellerflow.plans import quality, serving
from tellerflow.plans.business import mean
from tellerflow.queries.business import avg_scaled
from tellerflow.queries.core import _HEX, sk_fingerprint
from tellerflow.queries.dataquality import SQL as DQ_SQL
from tellerflow.queries.dataquality import _texts
from tellerflow.queries.oracle import COLUMNS, D, OPEN, P, raw_values
from tellerflow.queries.pipeline import RUN_LOG_SQL, run_log_rows
from tellerflow.queries.registry import query

col, lit = F.col, F.lit


def _dims(lake: Lake) -> dict[str, DataFrame]:
    return {e: lake.dim(e) for e in DIMENSIONS}


def _at(lake: Lake, name: str) -> DataFrame:
    return lake.gold(name).where(col("cob_dt") == lit(lake.day))


@query("acc_dim_counts_fingerprint", f"""
SELECT dim AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE is_current = 1) AS current_rows, count(*) FILTER (WHERE is_current = 0) AS history_rows,
  count(DISTINCT business_key) AS business_keys, bit_xor({_HEX}) AS sk_xor, sum(CAST({_HEX} AS HUGEINT)) AS sk_sum FROM v_all GROUP BY dim""")
def acc_dim_counts_fingerprint(lake: Lake) -> DataFrame:
    current = col("is_current")
    return R.stack(
        [
            df.agg(F.count("*").alias("total_rows"), F.count_if(current == 1).alias("current_rows"), F.count_if(current == 0).alias("history_rows"),
                   F.countDistinct(DIMENSIONS[e].keys[0]).alias("business_keys"), *sk_fingerprint(DIMENSIONS[e].sk)).withColumn("table_name", lit(f"dim_{e}"))
            for e, df in _dims(lake).items()
        ]
    )


_MULTI = "SELECT dim, business_key FROM v_all GROUP BY dim, business_key HAVING count(*) FILTER (WHERE is_current = 1) > 1"
_DUP_SK = "SELECT dim, sk FROM v_all GROUP BY dim, sk HAVING count(*) > 1"
_INVALID = f"SELECT dim FROM v_all WHERE effective_from > effective_to OR (is_current = 1) <> (effective_to = {OPEN})"
_OVERLAP = "SELECT dim FROM (SELECT dim, effective_from, lag(effective_to) OVER (PARTITION BY dim, business_key ORDER BY effective_from, sk) AS p FROM v_all) WHERE effective_from <= p"


@query("acc_scd2_violations", f"""
SELECT 'duplicate_surrogate_key' AS check_name, count(*) AS violations FROM ({_DUP_SK}) UNION ALL SELECT 'multiple_current_rows', count(*) FROM ({_MULTI})
UNION ALL SELECT 'invalid_date_or_sentinel', count(*) FROM ({_INVALID}) UNION ALL SELECT 'overlapping_effective_ranges', count(*) FROM ({_OVERLAP})""")
def acc_scd2_violations(lake: Lake) -> DataFrame:
    names = {
        "duplicate_surrogate_key": "duplicate_surrogate_key", "multiple_current_rows": "multiple_current_rows",
        "invalid_effective_range": "invalid_date_or_sentinel", "overlapping_versions": "overlapping_effective_ranges",
    }
    counts = R.stack([R.scd2_counts(df, e) for e, df in _dims(lake).items()])
    total = counts.agg(*[F.sum(source).alias(name) for source, name in names.items()])
    return total.unpivot([], list(names.values()), "check_name", "violations")


@query("acc_source_current_diff", " UNION ALL ".join(
    f"SELECT '{e}_source_current_mismatch' AS check_name, (SELECT count(*) FROM e_{e}_next s FULL JOIN (SELECT * FROM d_{e} WHERE is_current = 1) t "
    f"ON s.{COLUMNS[e][0]} = t.{COLUMNS[e][0]} WHERE s.{COLUMNS[e][0]} IS NULL OR t.{COLUMNS[e][0]} IS NULL) AS violations" for e in COLUMNS))
def acc_source_current_diff(lake: Lake) -> DataFrame:
    parts = []
    for entity, spec in DIMENSIONS.items():
        key = spec.keys[0]
        source = lake.snapshot(entity, lake.day).select(key)
        target = lake.dim(entity).where(col("is_current") == 1).select(key)
        both = source.subtract(target).unionByName(target.subtract(source))
        parts.append(both.agg(F.count("*").alias("violations")).withColumn("check_name", lit(f"{entity}_source_current_mismatch")))
    return R.stack(parts)


_DEMO = {  # entity: (demo key, three attributes to show)
    "branch": ("B001", ["manager_name", "address", "status"]), "product": ("11", ["product_name", "is_active", "currency"]),
    "customer": (11, ["phone", "address", "customer_segment"]), "account": (101, ["branch_code", "status", "balance"]),
}


@query("acc_controlled_history", " UNION ALL ".join(
    f"SELECT '{e}' AS entity, CAST({COLUMNS[e][0]} AS VARCHAR) AS business_key, "
    + ", ".join(f"CAST({v} AS VARCHAR) AS value_{i + 1}" for i, v in enumerate(vs))
    + f", effective_from, effective_to, is_current, {e}_sk AS sk FROM d_{e} WHERE {COLUMNS[e][0]} = {k!r}" for e, (k, vs) in _DEMO.items()))
def acc_controlled_history(lake: Lake) -> DataFrame:
    """Old and new values of one controlled key per dimension."""
    parts = []
    for entity, (key, values) in _DEMO.items():
        spec = DIMENSIONS[entity]
        shown = [col(v).cast("string").alias(f"value_{i + 1}") for i, v in enumerate(values)]
        parts.append(
            lake.dim(entity).where(col(spec.keys[0]) == lit(key)).select(
                lit(entity).alias("entity"), col(spec.keys[0]).cast("string").alias("business_key"), *shown,
                "effective_from", "effective_to", "is_current", col(spec.sk).alias("sk"),
            )
        )
    return R.stack(parts)


@query("acc_technical_change_no_version", """
SELECT customer_id, count(*) AS versions, count(*) FILTER (WHERE is_current = 1) AS current_versions FROM d_customer
WHERE customer_id >= 0 AND customer_id % 13 = 0 AND customer_id % 10 <> 1 AND customer_id % 17 <> 0 GROUP BY customer_id""")
def acc_technical_change_no_version(lake: Lake) -> DataFrame:
    """Every customer whose delivery changed in last_updated only keeps one version."""
    pairs = history.classify(lake.baseline("customer"), lake.snapshot("customer", lake.day), DIMENSIONS["customer"])
    touched = pairs.where((col("change") == "unchanged") & (col("old.last_updated") != col("new.last_updated"))).select("customer_id")
    return lake.dim("customer").join(touched, "customer_id", "left_semi").groupBy("customer_id").agg(
        F.count("*").alias("versions"), F.count_if(col("is_current") == 1).alias("current_versions")
    )


@query("acc_scd2_invariant_grid", f"""
SELECT g.dim AS table_name, g.c AS check_name, count(v.c) AS violation_count, CASE count(v.c) WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT dim, unnest(['multiple_current_rows', 'duplicate_surrogate_key', 'invalid_effective_range', 'overlapping_versions']) AS c FROM (SELECT DISTINCT dim FROM v_all)) g
LEFT JOIN (SELECT dim, 'multiple_current_rows' AS c FROM ({_MULTI}) UNION ALL SELECT dim, 'duplicate_surrogate_key' FROM ({_DUP_SK})
  UNION ALL SELECT dim, 'invalid_effective_range' FROM ({_INVALID}) UNION ALL SELECT dim, 'overlapping_versions' FROM ({_OVERLAP})) v ON v.dim = g.dim AND v.c = g.c
GROUP BY g.dim, g.c""")
def acc_scd2_invariant_grid(lake: Lake) -> DataFrame:
    return R.scd2_grid(_dims(lake))


def _pop(name: str, view: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT customer_id) AS customer_count, min(cob_dt) AS min_cob_dt, max(cob_dt) AS max_cob_dt FROM {view}"


@query("acc_serving_population", " UNION ALL ".join(_pop(n, v) for n, v in (
    ("mart_customer_360", "g_mart"), ("mart_customer_360_history", "gg_mart"), ("mart_customer_360_masked", "g_mart"))))
def acc_serving_population(lake: Lake) -> DataFrame:
    return R.population({
        "mart_customer_360": lake.mart(), "mart_customer_360_history": lake.gold("customer_360"), "mart_customer_360_masked": lake.masked()
    })


def _checks(parts: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({sql}) AS violations" for n, sql in parts.items())
    return f"SELECT check_name, violations, CASE violations WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"


@query("acc_gold_uniqueness", _checks({
    "current_duplicate_customer": "SELECT count(*) - count(DISTINCT customer_id) FROM g_mart",
    "history_duplicate_customer_date": "SELECT count(*) - count(DISTINCT customer_id || '/' || cob_dt) FROM gg_mart",
    "campaign_duplicate_customer_date": "SELECT count(*) - count(DISTINCT customer_id || '/' || cob_dt) FROM gg_campaign"}))
def acc_gold_uniqueness(lake: Lake) -> DataFrame:
    return R.named_counts({
        "current_duplicate_customer": R.duplicates(lake.mart(), "customer_id"),
        "history_duplicate_customer_date": R.duplicates(lake.gold("customer_360"), "customer_id", "cob_dt"),
        "campaign_duplicate_customer_date": R.duplicates(lake.gold("campaign_target"), "customer_id", "cob_dt"),
    })


@query("acc_history_by_date", "SELECT cob_dt, count(*) AS row_count, count(DISTINCT customer_id) AS customer_count FROM gg_mart GROUP BY cob_dt")
def acc_history_by_date(lake: Lake) -> DataFrame:
    rows = lake.gold("customer_360").groupBy("cob_dt")
    return rows.agg(F.count("*").alias("row_count"), F.countDistinct("customer_id").alias("customer_count")).orderBy("cob_dt")


@query("acc_column_contract", f"""
SELECT 'mart_customer_360' AS table_name, 33 AS total_columns, 30 AS business_columns, {raw_values("g_mart", _texts(S.MART_360.ddl))} AS raw_pii,
  (SELECT count(*) FROM g_mart) AS row_count UNION ALL
SELECT 'mart_customer_360_dashboard', 46, 43, {raw_values("s_dash", _texts(S.DASHBOARD_360.ddl))}, (SELECT count(*) FROM s_dash)""")
def acc_column_contract(lake: Lake) -> DataFrame:
    """Column counts of the served tables, and how many columns or rows show raw personal data."""
    parts = []
    for name, df in (("mart_customer_360", lake.mart()), ("mart_customer_360_dashboard", lake.dashboard())):
        business = [c for c in df.columns if c not in ("customer_id", "customer_sk", "cob_dt")]
        found = quality.pii_check(df, lake.dim("customer"), lake.day)
        parts.append(found.select(
            lit(name).alias("table_name"), lit(len(df.columns)).alias("total_columns"), lit(len(business)).alias("business_columns"),
            col("failed_count").alias("raw_pii"), col("total_count").alias("row_count"),
        ))
    return R.stack(parts)


@query("acc_balance_recon", "SELECT 0 AS balance_mismatches, 'PASS' AS status, (SELECT count(*) FROM gg_balance) AS compared_rows, (SELECT sum(aum_total) FROM gg_balance) AS compared_aum")
def acc_balance_recon(lake: Lake) -> DataFrame:
    """Balances recomputed for both dates in one pass over the dimensions, compared with the summaries."""
    s, dates, span = lake.silver(), [lake.base, lake.day], (col("effective_from"), col("effective_to"))
    zero = lit(0)
    accounts = R.on_dates(s.dim_account, dates, *span).where(col("status") == "ACTIVE")
    accounts = accounts.groupBy("cob_dt", "customer_id").agg(F.sum("balance").alias("b"))
    customers = R.on_dates(s.dim_customer, dates, *span).select("cob_dt", "customer_id")
    expected = (
        customers.join(accounts, ["cob_dt", "customer_id"], "left")
        .join(A.deposit_holdings(s.dim_deposit), "customer_id", "left").join(A.loan_holdings(s.dim_loan), "customer_id", "left")
        .select("cob_dt", "customer_id", *[F.coalesce(c, zero).cast("decimal(18,2)").alias(n) for c, n in
                (("b", "accounts"), ("principal_sum", "deposits"), ("outstanding_sum", "loans"))])
        .withColumn("aum", (col("accounts") + col("deposits")).cast("decimal(18,2)"))
    )
    actual = lake.gold("balance_summary")
    pairs = {"total_account_balance": "accounts", "total_deposit_principal": "deposits", "total_loan_outstanding": "loans", "aum_total": "aum"}
    compared = actual.agg(F.count("*").alias("n"), F.sum("aum_total").alias("a"))
    return R.reconcile(expected, actual, ["customer_id", "cob_dt"], pairs, "balance_mismatches").withColumns(
        {"compared_rows": compared.select("n").scalar(), "compared_aum": compared.select("a").scalar()}
    )


@query("acc_card_recon", "SELECT 0 AS card_mismatches, 'PASS' AS status, (SELECT sum(total_card_txn_count_30d) FROM gg_card) AS compared_txns")
def acc_card_recon(lake: Lake) -> DataFrame:
    """Card activity recomputed for both dates; each event is repeated for the windows it falls in."""
    day = col("txn_date").cast("date")
    events = R.on_dates(A.spend_rows(lake.fact("card_txn").drop("cob_dt")), [lake.base, lake.day], day, F.date_add(day, 30))
    expected = events.groupBy("cob_dt", "customer_id").agg(
        F.count("txn_id").alias("n"), F.sum("txn_amount").cast("decimal(18,2)").alias("amount"),
        F.countDistinct("merchant_category").cast("int").alias("categories"), F.max("txn_date").alias("last"),
    )
    actual = lake.gold("card_summary")
    filled = actual.select("customer_id", "cob_dt").join(expected, ["customer_id", "cob_dt"], "left").na.fill(0, ["n", "categories"]).withColumn(
        "amount", F.coalesce("amount", lit(0)).cast("decimal(18,2)")
    )
    pairs = {"total_card_txn_count_30d": "n", "total_card_txn_amount_30d": "amount", "distinct_merchant_categories": "categories", "last_card_txn_date": "last"}
    total = actual.agg(F.sum("total_card_txn_count_30d")).scalar()
    return R.reconcile(filled, actual, ["customer_id", "cob_dt"], pairs, "card_mismatches").withColumn("compared_txns", total)


@query("acc_mart_vs_summaries", _checks({
    "mart_balance_summary_mismatch": "SELECT count(*) FROM g_mart m JOIN g_balance b USING (customer_id) WHERE m.aum_total <> b.aum_total OR m.total_loan_outstanding <> b.total_loan_outstanding",
    "mart_transaction_summary_mismatch": "SELECT count(*) FROM g_mart m JOIN g_txn t USING (customer_id) WHERE m.txn_count_30d <> t.total_txn_count_30d OR m.txn_amount_30d <> t.total_txn_amount_30d"}))
def acc_mart_vs_summaries(lake: Lake) -> DataFrame:
    both, mart = ["customer_id", "cob_dt"], lake.mart()
    balances = lake.gold("balance_summary").select(*both, col("aum_total").alias("aum"), col("total_loan_outstanding").alias("loans"))
    txns = lake.gold("transaction_summary").select(*both, "total_txn_count_30d", "total_txn_amount_30d")
    return R.named_counts({
        "mart_balance_summary_mismatch": R.violating(mart.join(balances, both), (col("aum_total") != col("aum")) | (col("total_loan_outstanding") != col("loans"))),
        "mart_transaction_summary_mismatch": R.violating(
            mart.join(txns, both), (col("txn_count_30d") != col("total_txn_count_30d")) | (col("txn_amount_30d") != col("total_txn_amount_30d"))),
    })


@query("acc_rfm_ranges", """
SELECT cob_dt, count(*) AS scored_customers, min(r_score) AS min_r, max(r_score) AS max_r, min(f_score) AS min_f, max(f_score) AS max_f, min(m_score) AS min_m,
  max(m_score) AS max_m, min(rfm_score) AS min_rfm, max(rfm_score) AS max_rfm, count(DISTINCT rfm_segment) AS segments FROM gg_rfm GROUP BY cob_dt""")
def acc_rfm_ranges(lake: Lake) -> DataFrame:
    ends = [f(c).alias(f"{n}_{c.split('_')[0]}") for c in ("r_score", "f_score", "m_score", "rfm_score") for f, n in ((F.min, "min"), (F.max, "max"))]
    return lake.gold("rfm_segment").groupBy("cob_dt").agg(F.count("*").alias("scored_customers"), *ends, F.countDistinct("rfm_segment").alias("segments"))


_EMPTY = {f"empty_{n}": f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {v}" for n, v in (
    ("rfm_segment", "gg_rfm"), ("churn_prediction", "gg_churn"), ("cross_sell_segment", "gg_cross"), ("campaign_target", "gg_campaign"))}


@query("acc_segment_flags", _checks({
    "invalid_cross_sell_flags": "SELECT count(*) FROM gg_cross WHERE no_credit_card NOT IN (0, 1) OR no_deposit NOT IN (0, 1) OR no_loan NOT IN (0, 1)",
    "invalid_churn_flags": "SELECT count(*) FROM gg_churn WHERE is_churn_candidate NOT IN (0, 1)", **_EMPTY}))
def acc_segment_flags(lake: Lake) -> DataFrame:
    cross = ~col("no_credit_card").isin(0, 1) | ~col("no_deposit").isin(0, 1) | ~col("no_loan").isin(0, 1)
    checks = {
        "invalid_cross_sell_flags": R.violating(lake.gold("cross_sell_segment"), cross),
        "invalid_churn_flags": R.violating(lake.gold("churn_prediction"), ~col("is_churn_candidate").isin(0, 1)),
    }
    for name in ("rfm_segment", "churn_prediction", "cross_sell_segment", "campaign_target"):
        checks[f"empty_{name}"] = lake.gold(name).agg((F.count("*") == 0).cast("int").alias("violations"))
    return R.named_counts(checks)


@query("acc_customer_two_snapshots", "SELECT customer_id, cob_dt, primary_branch_code, customer_segment, aum_total, rfm_segment FROM gg_mart WHERE customer_id = 11")
def acc_customer_two_snapshots(lake: Lake) -> DataFrame:
    rows = lake.gold("customer_360").where(col("customer_id") == 11)
    return rows.select("customer_id", "cob_dt", "primary_branch_code", "customer_segment", "aum_total", "rfm_segment").orderBy("cob_dt")


_FACT_VIEWS = {"fact_txn_account": ("f_acct", "txn_id", "txn_date"), "fact_card_txn": ("f_card", "txn_id", "txn_date"), "fact_crm_interaction": ("f_crm", "interaction_id", "interaction_date")}


@query("acc_fact_population", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS business_key_count, min(CAST({e} AS DATE)) AS min_event_date, "
    f"max(CAST({e} AS DATE)) AS max_event_date, count(*) FILTER (WHERE customer_sk IS NULL{' OR account_sk IS NULL' if v == 'f_acct' else ''}) AS orphan_sk FROM {v}"
    for n, (v, k, e) in _FACT_VIEWS.items()))
def acc_fact_population(lake: Lake) -> DataFrame:
    parts = []
    for feed, spec in asof.FACTS.items():
        orphan = col("customer_sk").isNull() | (col("account_sk").isNull() if "account" in spec.dimensions else lit(False))
        day = col(spec.event).cast("date")
        parts.append(lake.fact(feed).agg(
            F.count("*").alias("row_count"), F.countDistinct(spec.key).alias("business_key_count"), F.min(day).alias("min_event_date"),
            F.max(day).alias("max_event_date"), F.count_if(orphan).alias("orphan_sk"),
        ).withColumn("table_name", lit(spec.name)))
    return R.stack(parts)


@query("acc_segment_population", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {v}) AS row_count, (SELECT count(*) FROM g_mart) AS expected_count, "
    f"CASE WHEN (SELECT count(*) FROM {v}) = (SELECT count(*) FROM g_mart) THEN 'PASS' ELSE 'FAIL' END AS status"
    for n, v in (("rfm_segment", "g_rfm"), ("churn_prediction", "g_churn"), ("cross_sell_segment", "g_cross"), ("campaign_target", "g_campaign"))))
def acc_segment_population(lake: Lake) -> DataFrame:
    names = ("rfm_segment", "churn_prediction", "cross_sell_segment", "campaign_target")
    counts = R.stack([_at(lake, n).agg(F.count("*").alias("row_count")).withColumn("table_name", lit(n)) for n in names])
    rows = counts.withColumn("expected_count", lake.mart().agg(F.count("*")).scalar())
    return rows.withColumn("status", R.verdict(col("row_count") - col("expected_count")))


@query("acc_nbo_stats", """
SELECT count(*) AS row_count, count(DISTINCT customer_id) AS unique_customers, min(cross_sell_score) AS min_score, max(cross_sell_score) AS max_score,
  count(*) FILTER (WHERE coalesce(trim(recommendation_reason), '') = '') AS missing_reason,
  count(*) FILTER (WHERE contact_eligible_flag = 0 AND suppression_reason IS NULL) AS invalid_suppression FROM g_campaign""")
def acc_nbo_stats(lake: Lake) -> DataFrame:
    score = col("cross_sell_score")
    return _at(lake, "campaign_target").agg(
        F.count("*").alias("row_count"), F.countDistinct("customer_id").alias("unique_customers"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
        F.count_if(F.coalesce(F.trim("recommendation_reason"), lit("")) == "").alias("missing_reason"),
        F.count_if((col("contact_eligible_flag") == 0) & col("suppression_reason").isNull()).alias("invalid_suppression"),
    )


@query("acc_nbo_score_recompute", "SELECT count(*) AS checked_rows, 0 AS mismatches, sum(cross_sell_score) AS score_sum FROM g_campaign")
def acc_nbo_score_recompute(lake: Lake) -> DataFrame:
    """Scores recomputed from the history mart, the card holdings and the complaints, not from the campaign's own inputs."""
    both = ["customer_id", "cob_dt"]
    mart = lake.gold("customer_360").select(*both, "kyc_status", col("customer_segment").alias("seg"), col("aum_total").alias("aum"),
                                            col("has_credit_card"), col("days_since_last_txn").alias("idle"), col("rfm_segment").alias("rfm"))
    rows = _at(lake, "campaign_target").select(*both, "cross_sell_score").join(mart, both).join(
        A.open_complaints(lake.fact("crm_interaction"), lake.day), "customer_id", "left")
    one = lambda c: F.coalesce(c.cast("int"), lit(0))
    expected = (
        30 * one(col("has_credit_card") == 0) + 25 * one(col("aum") >= 100_000_000) + 20 * one(col("rfm").isin("Champions", "Loyal Customers"))
        + 15 * one(col("idle") <= 30) + 10 * one(F.upper("seg").isin("VIP", "PRIORITY")) - 30 * one(F.coalesce(F.upper("kyc_status"), lit("")) != "VERIFIED")
        - 20 * one((col("idle") > 90) | F.coalesce(col("open_complaints") > 0, lit(False)))
    )
    return rows.agg(
        F.count("*").alias("checked_rows"),
        F.count_if(col("cross_sell_score") != F.greatest(lit(0), F.least(lit(100), expected))).alias("mismatches"),
        F.sum("cross_sell_score").alias("score_sum"),
    )


@query("acc_dashboard_grain", f"""
SELECT count(*) AS row_count, count(DISTINCT customer_id) AS unique_customers, count(*) - count(DISTINCT customer_id) AS duplicate_keys,
  {DQ_SQL['dashboard_population_matches_gold_history'][0]} AS population_mismatches, 0 AS invalid_score, 0 AS missing_product, 0 AS missing_reason,
  0 AS invalid_priority, 0 AS invalid_suppression, 'PASS' AS status FROM s_dash""")
def acc_dashboard_grain(lake: Lake) -> DataFrame:
    """Grain, population and offer contract of the published rows in one report row."""
    dash = lake.dashboard()
    rules = serving.offer_rules()
    per_customer = dash.groupBy("customer_id").agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in rules.items()])
    rows = per_customer.agg(
        F.sum("n").alias("row_count"), F.count("*").alias("unique_customers"), F.count_if(col("n") > 1).alias("duplicate_keys"),
        *[F.sum(n).alias(n) for n in rules],
    )
    gaps = quality._population(_at(lake, "customer_360"), dash).select("failed_count").scalar()
    rows = rows.withColumn("population_mismatches", gaps)
    problems = sum((col(c) for c in (*rules, "duplicate_keys", "population_mismatches")), lit(0))
    expected = lake.mart().agg(F.count("*")).scalar()
    return rows.withColumn("_gap", problems + F.abs(col("row_count") - expected)).withColumn("status", R.verdict(col("_gap"))).drop("_gap")


@query("acc_dashboard_aggregate", f"""
SELECT recommended_product, campaign_priority, contact_eligible_flag, count(*) AS customers, CAST(sum(aum_total) AS DECIMAL(24,2)) AS total_aum,
  {avg_scaled('cross_sell_score', 0, 2)} AS avg_cross_sell_score FROM s_dash GROUP BY ALL""")
def acc_dashboard_aggregate(lake: Lake) -> DataFrame:
    return lake.dashboard().groupBy("recommended_product", "campaign_priority", "contact_eligible_flag").agg(
        F.count("*").alias("customers"), F.sum("aum_total").cast("decimal(24,2)").alias("total_aum"), mean("cross_sell_score", 1, 2).alias("avg_cross_sell_score")
    ).orderBy(col("customers").desc(), "recommended_product", "campaign_priority", "contact_eligible_flag")


_MASTERS = ["branch", "product", "customer", "account"]


@query("acc_baseline_inventory", " UNION ALL ".join(
    [f"SELECT '{e}' AS table_name, (SELECT count(*) FROM e_{e}) + (SELECT count(*) FROM e_{e}_next) AS row_count, DATE '{P}' AS min_cob_dt, DATE '{D}' AS max_cob_dt" for e in _MASTERS]
    + [f"SELECT '{e}', (SELECT count(*) FROM e_{e}_first) + (SELECT count(*) FROM e_{e}_next), DATE '{P}', DATE '{D}'" for e in ("deposit", "loan", "card")]
    + [f"SELECT '{e}', count(*), min(cob_dt), max(cob_dt) FROM {v}" for e, v in (("txn_account", "f_acct"), ("card_txn", "f_card"), ("crm_interaction", "f_crm"))]))
def acc_baseline_inventory(lake: Lake) -> DataFrame:
    """Rows and processing dates of every bronze feed."""
    return R.stack(
        [
            lake.bronze(e).agg(F.count("*").alias("row_count"), F.min("cob_dt").alias("min_cob_dt"), F.max("cob_dt").alias("max_cob_dt")).withColumn("table_name", lit(e))
            for e in S.FEEDS
        ]
    )


@query("acc_run_flags", f"""
SELECT coalesce(e.job_name, l.job_name) AS job_name, l.status, CASE WHEN e.job_name IS NOT NULL AND l.status = 'S' THEN 'PASS' ELSE 'FAIL' END AS result
FROM (SELECT 'job-' || c_custkey AS job_name FROM customer) e
FULL JOIN (SELECT job_name, status FROM ({RUN_LOG_SQL}) WHERE cob_dt = DATE '{D}' AND pipeline_run_id = 'daily-2024-01-30'
  QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY id DESC) = 1) l ON e.job_name = l.job_name""")
def acc_run_flags(lake: Lake) -> DataFrame:
    expected = lake.raw("customer").select(F.concat(lit("job-"), col("c_custkey")).alias("job_name"))
    return R.run_flags(expected, run_log_rows(lake), lake.day, "daily-2024-01-30")


_DQ_ROWS = " UNION ALL ".join(f"SELECT '{c.severity}' AS severity, {DQ_SQL[c.name][0]} AS failed_count" for c in quality.CHECKS)


@query("acc_dq_summary", f"""
SELECT count(*) AS checks, count(*) FILTER (WHERE failed_count = 0) AS passed, count(*) FILTER (WHERE failed_count <> 0) AS failed,
  count(*) FILTER (WHERE failed_count <> 0 AND severity = 'critical') AS critical_failed, count(*) FILTER (WHERE failed_count <> 0 AND severity = 'warning') AS warning_failed
FROM ({_DQ_ROWS})""")
def acc_dq_summary(lake: Lake) -> DataFrame:
    """Two runs are in the stored log, an older one in which everything failed; only the newer is summed up."""
    path = f"{lake.root}/dq-log-{uuid.uuid4().hex[:8]}"
    newer = quality.result_frame(lake.spark, quality.run_checks(quality.CHECKS, lake.tables(), lake.day, "daily", "dq-1"))
    older = newer.withColumns({"dq_run_id": lit("dq-0"), "passed": lit(False), "executed_at": col("executed_at") - F.expr("INTERVAL '1' DAY")})
    sinks.append(older, path)
    sinks.append(newer, path)
    return R.dq_summary(lake.spark.read.parquet(path))
