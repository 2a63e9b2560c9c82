"""Projections, joins, aggregates, windows, sorts, set operations and functions over the banking model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerflow.functions import columns as C
from tellerflow.lake import Lake
from tellerflow.operators import activity as A
from tellerflow.operators import asof, distinct, ranking
from tellerflow.operators.history import DIMENSIONS, classify, ordered_ranges
from tellerflow.plans import marts
from tellerflow.queries.oracle import COLUMNS, D, P
from tellerflow.queries.registry import query
from tellerflow.sources.files import asof_dimension

col, lit = F.col, F.lit

# --- projections and filters -----------------------------------------------------------------------


@query("project_rename_cast", """
SELECT customer_id, branch_code AS primary_branch_code, CAST(customer_id AS VARCHAR) AS customer_text,
  CAST(is_active AS BIGINT) AS active_flag, register_date FROM e_customer""")
def project_rename_cast(lake: Lake) -> DataFrame:
    return lake.feed("customer").select(
        "customer_id", col("branch_code").alias("primary_branch_code"), col("customer_id").cast("string").alias("customer_text"),
        col("is_active").cast("long").alias("active_flag"), "register_date",
    )


@query("case_bucket_ladder", f"""
SELECT account_id, CASE WHEN balance < 100000000 THEN 'MASS' WHEN balance < 1000000000 THEN 'AFFLUENT' WHEN balance < 5000000000 THEN 'PRIORITY' ELSE 'VIP' END AS aum_bucket,
  (month(open_date) + 2) // 3 AS open_quarter,
  CASE WHEN date_diff('day', open_date, DATE '{D}') <= 9000 THEN 'young' WHEN date_diff('day', open_date, DATE '{D}') <= 10000 THEN 'middle' ELSE 'old' END AS age_class
FROM e_account""")
def case_bucket_ladder(lake: Lake) -> DataFrame:
    age = F.datediff(lit(lake.day), col("open_date"))
    return lake.feed("account").select(
        "account_id", C.aum_bucket(col("balance")).alias("aum_bucket"), F.quarter("open_date").alias("open_quarter"),
        C.ladder([(age > 10000, "old"), (age > 9000, "middle")], "young").alias("age_class"),
    )


@query("binary_flag", """
SELECT card_id, CASE card_type WHEN 'CREDIT' THEN 1 ELSE 0 END AS is_credit,
  CASE WHEN credit_limit >= 50000000 THEN 1 ELSE 0 END AS high_limit, CASE WHEN account_id IS NULL THEN 1 ELSE 0 END AS no_account
FROM e_card""")
def binary_flag(lake: Lake) -> DataFrame:
    return lake.feed("card").select(
        "card_id", C.flag(col("card_type") == "CREDIT").alias("is_credit"), C.flag(col("credit_limit") >= 50_000_000).alias("high_limit"),
        C.flag(col("account_id").isNull()).alias("no_account"),
    )


@query("filter_in_not_in", """
SELECT interaction_id, category, status FROM e_crm WHERE category IN ('COMPLAINT', 'RETENTION') AND status NOT IN ('CLOSED', 'RESOLVED')""")
def filter_in_not_in(lake: Lake) -> DataFrame:
    # a NULL status is neither in nor not in the list, so those rows are dropped
    rows = lake.feed("crm_interaction").where(col("category").isin("COMPLAINT", "RETENTION") & ~col("status").isin("CLOSED", "RESOLVED"))
    return rows.select("interaction_id", "category", "status")


@query("filter_between_dates", f"""
SELECT txn_id, customer_id, txn_date, txn_amount FROM f_acct WHERE CAST(txn_date AS DATE) >= DATE '{D}' - 30 AND CAST(txn_date AS DATE) <= DATE '{D}'""")
def filter_between_dates(lake: Lake) -> DataFrame:
    rows = lake.fact("txn_account").where(C.in_window(col("cob_dt"), lake.day, 30))
    return rows.select("txn_id", "customer_id", "txn_date", "txn_amount")


@query("filter_like_prefix", "SELECT customer_id, branch_code FROM e_customer WHERE branch_code LIKE 'B01%'")
def filter_like_prefix(lake: Lake) -> DataFrame:
    return lake.feed("customer").where(col("branch_code").startswith("B01")).select("customer_id", "branch_code")


@query("filter_point_lookup", "SELECT * FROM g_mart WHERE customer_id = 12")
def filter_point_lookup(lake: Lake) -> DataFrame:
    return lake.mart().where(col("customer_id") == 12)


@query("null_default_coalesce", """
SELECT c.customer_id, coalesce(c.email, 'UNKNOWN') AS email, coalesce(k.top_limit, 0) AS credit_limit FROM e_customer c LEFT JOIN h_card k USING (customer_id)""")
def null_default_coalesce(lake: Lake) -> DataFrame:
    limits = A.card_holdings(lake.dim_current("card")).select("customer_id", "limit_max")
    return lake.feed("customer").join(limits, "customer_id", "left").select(
        "customer_id", F.coalesce("email", lit("UNKNOWN")).alias("email"), F.coalesce("limit_max", lit(0)).cast(C.MONEY).alias("credit_limit")
    )


@query("nullsafe_compare", """
SELECT customer_id, b.phone AS old_phone, s.phone AS new_phone FROM e_customer b JOIN e_customer_next s USING (customer_id) WHERE b.phone IS DISTINCT FROM s.phone""")
def nullsafe_compare(lake: Lake) -> DataFrame:
    old = lake.feed("customer").select("customer_id", col("phone").alias("old_phone"))
    new = lake.snapshot("customer", lake.day).select("customer_id", col("phone").alias("new_phone"))
    return old.join(new, "customer_id").where(~col("old_phone").eqNullSafe(col("new_phone")))


@query("sentinel_to_null", f"""
SELECT customer_id, last_30 AS last_txn_date, coalesce(date_diff('day', CAST(last_30 AS DATE), DATE '{D}'), 99999) AS days_since_last_txn FROM a_both""")
def sentinel_to_null(lake: Lake) -> DataFrame:
    last = F.nullif(col("last_txn_date"), C.ts_lit(C.NEVER_TS))
    return lake.gold("transaction_summary").where(col("cob_dt") == lit(lake.day)).select(
        "customer_id", last.alias("last_txn_date"),
        F.coalesce(F.datediff(lit(lake.day), last.cast("date")), lit(C.NEVER_DAYS)).alias("days_since_last_txn"),
    )


# --- joins -----------------------------------------------------------------------------------------


@query("join_left_equi_star", """
SELECT c.customer_id, coalesce(a.accounts, 0) AS accounts, coalesce(d.n, 0) AS deposits, coalesce(l.n, 0) AS loans, coalesce(k.n, 0) AS cards
FROM h_cust c LEFT JOIN h_acct a USING (customer_id) LEFT JOIN h_dep d USING (customer_id) LEFT JOIN h_loan l USING (customer_id) LEFT JOIN h_card k USING (customer_id)""")
def join_left_equi_star(lake: Lake) -> DataFrame:
    s = lake.silver()
    rows = marts.star(
        asof_dimension(s.dim_customer, lake.day).select("customer_id"), A.account_holdings(asof_dimension(s.dim_account, lake.day)),
        A.deposit_holdings(s.dim_deposit), A.loan_holdings(s.dim_loan), A.card_holdings(s.dim_card),
    )
    return rows.select("customer_id", *[F.coalesce(col(c), lit(0)).alias(c) for c in ("accounts", "deposits", "loans", "cards")])


@query("join_inner_equi", "SELECT m.customer_id, m.cob_dt, m.aum_total, h.churn_risk FROM gg_mart m, gg_churn h WHERE m.customer_id = h.customer_id AND m.cob_dt = h.cob_dt")
def join_inner_equi(lake: Lake) -> DataFrame:
    both = ["customer_id", "cob_dt"]
    churn = lake.gold("churn_prediction").select(*both, "churn_risk")
    return lake.gold("customer_360").select(*both, "aum_total").join(churn, both)


@query("join_multi_key_left", """
SELECT r.customer_id, r.cob_dt, r.rfm_segment, x.primary_opportunity FROM gg_rfm r LEFT JOIN g_cross x ON r.customer_id = x.customer_id AND r.cob_dt = x.cob_dt""")
def join_multi_key_left(lake: Lake) -> DataFrame:
    both = ["customer_id", "cob_dt"]
    cross = lake.gold("cross_sell_segment").where(col("cob_dt") == lit(lake.day)).select(*both, "primary_opportunity")
    return lake.gold("rfm_segment").select(*both, "rfm_segment").join(cross, both, "left")


_ASOF = """
SELECT t.txn_id, t.account_id, a.account_sk FROM e_txn t LEFT JOIN d_account a ON t.account_id = a.account_id
  AND CAST(t.txn_date AS DATE) >= a.effective_from AND CAST(t.txn_date AS DATE) <= a.effective_to"""


def _events_with_account(lake: Lake, **options: object) -> DataFrame:
    lookup = [asof.Lookup(lake.dim("account"), "account_id", "account_sk")]
    return asof.resolve(lake.feed("txn_account").select("txn_id", "account_id", "txn_date"), "txn_date", lookup, merge=True, **options).drop("txn_date")


@query("join_asof_range_left", _ASOF)
def join_asof_range_left(lake: Lake) -> DataFrame:
    return _events_with_account(lake)


@query("join_asof_bootstrap", "SELECT txn_id, account_id, account_sk FROM f_acct")
def join_asof_bootstrap(lake: Lake) -> DataFrame:
    return _events_with_account(lake, bootstrap=True)


@query("join_asof_range_inner", f"SELECT * FROM ({_ASOF}) WHERE account_sk IS NOT NULL")
def join_asof_range_inner(lake: Lake) -> DataFrame:
    return _events_with_account(lake, how="inner")


@query("join_full_outer_mismatch", """
SELECT coalesce(b.customer_id, s.customer_id) AS customer_id, CASE WHEN s.customer_id IS NULL THEN 'gone' ELSE 'new' END AS side
FROM e_customer b FULL JOIN e_customer_next s ON b.customer_id = s.customer_id WHERE b.customer_id IS NULL OR s.customer_id IS NULL""")
def join_full_outer_mismatch(lake: Lake) -> DataFrame:
    old = lake.feed("customer").select("customer_id", lit(1).alias("o"))
    new = lake.snapshot("customer", lake.day).select("customer_id", lit(1).alias("n"))
    rows = old.join(new, "customer_id", "full_outer").where(col("o").isNull() | col("n").isNull())
    return rows.select("customer_id", F.when(col("n").isNull(), "gone").otherwise("new").alias("side"))


@query("join_left_anti", "SELECT account_id, customer_id FROM e_account WHERE account_id NOT IN (SELECT account_id FROM e_account_next)")
def join_left_anti(lake: Lake) -> DataFrame:
    return lake.feed("account").select("account_id", "customer_id").join(lake.snapshot("account", lake.day), "account_id", "left_anti")


@query("join_cross_scalar", """
SELECT name AS table_name, n AS row_count, (SELECT count(*) FROM g_mart) AS expected_count,
  CASE WHEN n = (SELECT count(*) FROM g_mart) THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT 'rfm_segment' AS name, count(*) AS n FROM g_rfm UNION ALL SELECT 'churn_prediction', count(*) FROM g_churn UNION ALL SELECT 'dim_customer', count(*) FROM d_customer)""")
def join_cross_scalar(lake: Lake) -> DataFrame:
    # the one-row side is a scalar subquery: one value per executor, no cross join
    at = col("cob_dt") == lit(lake.day)
    parts = {"rfm_segment": lake.gold("rfm_segment").where(at), "churn_prediction": lake.gold("churn_prediction").where(at), "dim_customer": lake.dim("customer")}
    expected = lake.mart().agg(F.count("*")).scalar()
    rows = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("row_count")).select(lit(name).alias("table_name"), "row_count")
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("expected_count", expected).withColumn(
        "status", F.when(col("row_count") == col("expected_count"), "PASS").otherwise("FAIL")
    )


def _faulty(lake: Lake) -> DataFrame:
    """A history in which the closed versions of some keys run one day too long."""
    late = (col("is_current") == 0) & (col("account_id") % 4 == 1)
    return lake.dim("account").withColumn("effective_to", F.when(late, F.date_add("effective_to", 1)).otherwise(col("effective_to")))


_FAULTY = "(SELECT * REPLACE (CASE WHEN is_current = 0 AND account_id % 4 = 1 THEN effective_to + 1 ELSE effective_to END AS effective_to) FROM d_account)"


@query("join_self_range_overlap", f"""
SELECT b.account_id, b.effective_from, b.effective_to FROM {_FAULTY} b
WHERE EXISTS (SELECT 1 FROM {_FAULTY} a WHERE a.account_id = b.account_id AND a.effective_from < b.effective_from AND b.effective_from <= a.effective_to)""")
def join_self_range_overlap(lake: Lake) -> DataFrame:
    """Versions that begin inside an earlier version: the furthest end so far replaces the self join of all pairs."""
    ranges = _faulty(lake).groupBy("account_id", "effective_from").agg(F.max("effective_to").alias("effective_to"))
    by_day = Window.partitionBy("account_id").orderBy("effective_from").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("furthest", F.max("effective_to").over(by_day)).where(col("effective_from") <= col("furthest")).drop("furthest")


@query("join_dates_theta", f"""
SELECT d.cob_dt, t.customer_id, count(*) AS txn_count, sum(t.txn_amount) AS txn_amount, count(DISTINCT t.merchant_category) AS merchant_categories
FROM (VALUES (DATE '{P}'), (DATE '{D}')) d(cob_dt), f_card t
WHERE t.cob_dt BETWEEN d.cob_dt - 30 AND d.cob_dt AND t.status = 'SUCCESS' AND t.txn_type NOT IN ('REFUND', 'REVERSAL') GROUP BY d.cob_dt, t.customer_id""")
def join_dates_theta(lake: Lake) -> DataFrame:
    """Each event meets the report dates whose window it falls in: an array filter per row instead of a theta join."""
    dates = F.array(lit(lake.base), lit(lake.day))
    hit = F.filter(dates, lambda d: col("event_day").between(F.date_sub(d, 30), d))
    rows = A.spend_rows(lake.fact("card_txn")).withColumn("event_day", col("cob_dt")).withColumn("cob_dt", F.explode(hit))
    return rows.groupBy("cob_dt", "customer_id").agg(
        F.count("*").alias("txn_count"), F.sum("txn_amount").alias("txn_amount"), F.countDistinct("merchant_category").alias("merchant_categories")
    )


@query("scalar_subquery", """
SELECT customer_segment, count(*) AS customers, (SELECT count(*) FROM e_customer) AS all_customers FROM e_customer GROUP BY customer_segment""")
def scalar_subquery(lake: Lake) -> DataFrame:
    customers = lake.feed("customer")
    total = customers.agg(F.count("*")).scalar()
    return customers.groupBy("customer_segment").agg(F.count("*").alias("customers")).withColumn("all_customers", total)


@query("change_detection_join", """
SELECT s.account_id, CASE WHEN b.account_id IS NULL THEN 'new'
  WHEN (b.balance, b.branch_code, b.status) IS DISTINCT FROM (s.balance, s.branch_code, s.status) THEN 'changed' ELSE 'unchanged' END AS change
FROM e_account_next s LEFT JOIN e_account b USING (account_id)""")
def change_detection_join(lake: Lake) -> DataFrame:
    pairs = classify(lake.baseline("account"), lake.snapshot("account", lake.day), DIMENSIONS["account"])
    return pairs.where(col("change") != "deleted").select("account_id", "change")


# --- aggregates ------------------------------------------------------------------------------------


@query("agg_count_sum_avg_max", """
SELECT customer_id, count(txn_id) AS txn_count, sum(txn_amount) AS txn_amount, round(avg(CAST(txn_amount AS DOUBLE)), 4) AS avg_amount, max(txn_date) AS last_txn
FROM e_card_txn GROUP BY customer_id""")
def agg_count_sum_avg_max(lake: Lake) -> DataFrame:
    return lake.feed("card_txn").groupBy("customer_id").agg(
        F.count("txn_id").alias("txn_count"), F.sum("txn_amount").alias("txn_amount"),
        F.round(F.avg(col("txn_amount").cast("double")), 4).alias("avg_amount"), F.max("txn_date").alias("last_txn"),
    )


@query("agg_conditional", """
SELECT customer_id, sum(CASE WHEN status = 'ACTIVE' THEN balance ELSE 0 END) AS active_balance, count(CASE WHEN status = 'FROZEN' THEN 1 END) AS frozen,
  max(CASE WHEN account_type = 'CASA' THEN open_date END) AS last_casa_open FROM e_account GROUP BY customer_id""")
def agg_conditional(lake: Lake) -> DataFrame:
    return lake.feed("account").groupBy("customer_id").agg(
        F.sum(F.when(col("status") == "ACTIVE", col("balance")).otherwise(lit(0))).alias("active_balance"),
        F.count_if(col("status") == "FROZEN").alias("frozen"), F.max(F.when(col("account_type") == "CASA", col("open_date"))).alias("last_casa_open"),
    )


@query("agg_count_distinct", """
SELECT channel, count(DISTINCT customer_id) AS customers, count(DISTINCT CASE WHEN status = 'SUCCESS' THEN merchant_category END) AS categories FROM e_card_txn GROUP BY channel""")
def agg_count_distinct(lake: Lake) -> DataFrame:
    """By bitmaps: customers by their ids, categories by numbers given to them."""
    rows = lake.feed("card_txn").select("channel", "customer_id", F.when(col("status") == "SUCCESS", col("merchant_category")).alias("merchant_category"))
    rows = rows.join(distinct.extend(None, rows, "merchant_category"), "merchant_category", "left")
    return distinct.count_distinct(rows, ["channel"], {"customers": col("customer_id"), "categories": col("number")})


@query("agg_having_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def agg_having_duplicates(lake: Lake) -> DataFrame:
    return lake.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where(col("n") > 1)


@query("agg_global", "SELECT count(*) AS row_count, count(DISTINCT customer_id) AS unique_customers, min(aum_total) AS min_aum, max(aum_total) AS max_aum, sum(aum_total) AS total_aum FROM g_mart")
def agg_global(lake: Lake) -> DataFrame:
    return lake.mart().agg(
        F.count("*").alias("row_count"), F.countDistinct("customer_id").alias("unique_customers"), F.min("aum_total").alias("min_aum"),
        F.max("aum_total").alias("max_aum"), F.sum("aum_total").alias("total_aum"),
    )


@query("agg_min_max_range", "SELECT cob_dt, min(rfm_score) AS min_rfm, max(rfm_score) AS max_rfm, min(recency_days) AS min_recency FROM gg_rfm GROUP BY cob_dt")
def agg_min_max_range(lake: Lake) -> DataFrame:
    return lake.gold("rfm_segment").groupBy("cob_dt").agg(
        F.min("rfm_score").alias("min_rfm"), F.max("rfm_score").alias("max_rfm"), F.min("recency_days").alias("min_recency")
    )


@query("agg_count_if", "SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current = 1) AS current_rows, count(*) FILTER (WHERE is_current = 0) AS history_rows FROM d_account")
def agg_count_if(lake: Lake) -> DataFrame:
    current = col("is_current")
    return lake.dim("account").agg(F.count("*").alias("total_rows"), F.count_if(current == 1).alias("current_rows"), F.count_if(current == 0).alias("history_rows"))


_SHARE = "CAST((2000 * count(*) + (SELECT count(*) FROM g_mart)) // (2 * (SELECT count(*) FROM g_mart)) AS DECIMAL(18,1)) * 0.1"


def _share(count: str = "customer_count"):
    """Percentage of the total at one decimal, half up; the window runs over the few aggregated rows."""
    return F.round(col(count).cast("decimal(18,0)") * 100 / F.sum(count).over(Window.partitionBy()), 1)


@query("agg_of_window_ratio", f"SELECT rfm_segment, count(*) AS customer_count, {_SHARE} AS pct_of_total FROM g_mart GROUP BY rfm_segment")
def agg_of_window_ratio(lake: Lake) -> DataFrame:
    return lake.mart().groupBy("rfm_segment").agg(F.count("*").alias("customer_count")).withColumn("pct_of_total", _share())


@query("agg_multi_dim", "SELECT recommended_product, campaign_priority, contact_eligible_flag, count(*) AS customers FROM g_campaign GROUP BY ALL")
def agg_multi_dim(lake: Lake) -> DataFrame:
    rows = lake.gold("campaign_target").where(col("cob_dt") == lit(lake.day))
    return rows.groupBy("recommended_product", "campaign_priority", "contact_eligible_flag").agg(F.count("*").alias("customers"))


@query("agg_expression_key", "SELECT substr(branch_code, 1, 3) AS prefix, year(open_date) AS open_year, count(*) AS accounts FROM e_account GROUP BY 1, 2")
def agg_expression_key(lake: Lake) -> DataFrame:
    return lake.feed("account").groupBy(F.substring("branch_code", 1, 3).alias("prefix"), F.year("open_date").alias("open_year")).agg(F.count("*").alias("accounts"))


_HEX = "CAST('0x' || substr(sk, 1, 15) AS BIGINT)"


def sk_fingerprint(sk: str) -> list:
    """Mergeable fingerprint of a set of hash keys: exclusive or and sum of their leading 60 bits."""
    number = F.conv(F.substring(sk, 1, 15), 16, 10).cast("long")
    return [F.bit_xor(number).alias("sk_xor"), F.sum(number.cast("decimal(38,0)")).alias("sk_sum")]


@query("agg_fingerprint", f"SELECT dim AS table_name, count(*) AS row_count, bit_xor({_HEX}) AS sk_xor, sum(CAST({_HEX} AS HUGEINT)) AS sk_sum FROM v_all GROUP BY dim")
def agg_fingerprint(lake: Lake) -> DataFrame:
    rows = None
    for entity, spec in DIMENSIONS.items():
        one = lake.dim(entity).agg(F.count("*").alias("row_count"), *sk_fingerprint(spec.sk)).withColumn("table_name", lit(spec.name))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("agg_distinct", "SELECT DISTINCT customer_id, account_type FROM e_account")
def agg_distinct(lake: Lake) -> DataFrame:
    return lake.feed("account").select("customer_id", "account_type").distinct()


# --- windows ---------------------------------------------------------------------------------------


@query("win_ntile_scores", "SELECT customer_id, r AS r_score, f AS f_score, m AS m_score FROM g_rank")
def win_ntile_scores(lake: Lake) -> DataFrame:
    base = lake.gold("rfm_segment").where((col("cob_dt") == lit(lake.day)) & (col("frequency") > 0))
    base = base.select("customer_id", "recency_days", "frequency", "monetary")
    orders = {"r_score": -col("recency_days"), "f_score": col("frequency"), "m_score": col("monetary")}
    return ranking.ntile(base, "customer_id", orders).select("customer_id", *orders)


@query("win_top1_by_count", "SELECT customer_id, primary_channel FROM a_channel")
def win_top1_by_count(lake: Lake) -> DataFrame:
    rows = lake.fact("txn_account").where(C.in_window(col("cob_dt"), lake.day, 30))
    counted = rows.groupBy("customer_id", "channel").agg(F.count("*").alias("n"))
    return counted.groupBy("customer_id").agg(F.min_by("channel", F.struct(-col("n"), col("channel"))).alias("primary_channel"))


@query("win_top1_branch_channel", "SELECT branch_code, txn_year, txn_month, top_channel FROM g_branch")
def win_top1_branch_channel(lake: Lake) -> DataFrame:
    return marts.branch_monthly_summary(lake.silver(), lake.day).select("branch_code", "txn_year", "txn_month", "top_channel")


@query("win_first_value_min", "SELECT account_id, effective_from, min(effective_from) OVER (PARTITION BY account_id) AS first_effective_from FROM d_account")
def win_first_value_min(lake: Lake) -> DataFrame:
    """Per-key minimum as aggregate and join: the aggregate combines before the shuffle and the join splits a hot key."""
    rows = lake.dim("account").select("account_id", "effective_from")
    return rows.join(rows.groupBy("account_id").agg(F.min("effective_from").alias("first_effective_from")), "account_id")


@query("win_lag_overlap", f"""
SELECT account_id, effective_from, effective_to, previous_to FROM (
  SELECT *, lag(effective_to) OVER (PARTITION BY account_id ORDER BY effective_from, effective_to) AS previous_to FROM {_FAULTY})
WHERE effective_from <= previous_to""")
def win_lag_overlap(lake: Lake) -> DataFrame:
    rows = ordered_ranges(_faulty(lake), DIMENSIONS["account"]).where(col("effective_from") <= col("previous_to"))
    return rows.select("account_id", "effective_from", "effective_to", "previous_to")


@query("win_latest_per_key", """
SELECT customer_id, category, status, interaction_id FROM e_crm QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY interaction_id DESC) = 1""")
def win_latest_per_key(lake: Lake) -> DataFrame:
    latest = F.max_by(F.struct("category", "status", "interaction_id"), "interaction_id").alias("last")
    return lake.feed("crm_interaction").groupBy("customer_id").agg(latest).select("customer_id", "last.*")


@query("win_total_over_all", "SELECT campaign_priority, count(*) AS customers, sum(count(*)) OVER () AS all_customers FROM g_campaign GROUP BY campaign_priority")
def win_total_over_all(lake: Lake) -> DataFrame:
    rows = lake.gold("campaign_target").where(col("cob_dt") == lit(lake.day)).groupBy("campaign_priority").agg(F.count("*").alias("customers"))
    return rows.withColumn("all_customers", F.sum("customers").over(Window.partitionBy()))


@query("win_row_number_ids", "SELECT row_number() OVER (ORDER BY customer_id, account_id) AS id, account_id, customer_id FROM e_account")
def win_row_number_ids(lake: Lake) -> DataFrame:
    return ranking.dense_ids(lake.feed("account").select("account_id", "customer_id"), ["customer_id", "account_id"], "id")


# --- sorts -----------------------------------------------------------------------------------------


@query("topk_order_limit", "SELECT customer_id, aum_total FROM g_mart ORDER BY aum_total DESC, customer_id LIMIT 500")
def topk_order_limit(lake: Lake) -> DataFrame:
    return lake.mart().select("customer_id", "aum_total").orderBy(col("aum_total").desc(), "customer_id").limit(500)


SEGMENT_ORDER = ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "At Risk", "Hibernating", "Lost"]


def segment_rank(segment: str = "rfm_segment"):
    return C.ladder([(col(segment) == name, i + 1) for i, name in enumerate(SEGMENT_ORDER)], 8)


_SEG_RANK = "coalesce(list_position(['Champions', 'Loyal Customers', 'Potential Loyalists', 'New Customers', 'At Risk', 'Hibernating', 'Lost'], rfm_segment), 8)"


@query("order_by_case_rank", f"SELECT rfm_segment, count(*) AS customers, any_value({_SEG_RANK}) AS business_order FROM g_rfm GROUP BY rfm_segment ORDER BY 3")
def order_by_case_rank(lake: Lake) -> DataFrame:
    rows = lake.gold("rfm_segment").where(col("cob_dt") == lit(lake.day)).groupBy("rfm_segment").agg(F.count("*").alias("customers"))
    return rows.withColumn("business_order", segment_rank()).orderBy("business_order")


@query("order_by_multi", """
SELECT campaign_priority, contact_eligible_flag, recommended_product, count(*) AS customers FROM g_campaign GROUP BY ALL ORDER BY 1, 2, customers DESC, 3""")
def order_by_multi(lake: Lake) -> DataFrame:
    rows = lake.gold("campaign_target").where(col("cob_dt") == lit(lake.day))
    rows = rows.groupBy("campaign_priority", "contact_eligible_flag", "recommended_product").agg(F.count("*").alias("customers"))
    return rows.orderBy("campaign_priority", "contact_eligible_flag", col("customers").desc(), "recommended_product")


@query("existence_probe", """
SELECT 'null_email' AS probe, EXISTS (SELECT 1 FROM e_customer WHERE email IS NULL) AS found UNION ALL
SELECT 'null_name', EXISTS (SELECT 1 FROM e_customer WHERE full_name IS NULL) UNION ALL
SELECT 'inactive', EXISTS (SELECT 1 FROM e_customer WHERE is_active = 0)""")
def existence_probe(lake: Lake) -> DataFrame:
    """Several probes folded into one aggregate pass."""
    probes = {"null_email": col("email").isNull(), "null_name": col("full_name").isNull(), "inactive": col("is_active") == 0}
    found = lake.feed("customer").agg(*[F.bool_or(c).alias(n) for n, c in probes.items()])
    return found.unpivot([], list(probes), "probe", "found")


# --- set operations --------------------------------------------------------------------------------


@query("union_all_checks", " UNION ALL ".join(
    f"SELECT '{e}' AS entity, CAST({COLUMNS[e][0]} AS VARCHAR) AS business_key FROM d_{e} WHERE is_current = 0" for e in COLUMNS))
def union_all_checks(lake: Lake) -> DataFrame:
    rows = None
    for entity, spec in DIMENSIONS.items():
        one = lake.dim(entity).where(col("is_current") == 0).select(lit(entity).alias("entity"), col(spec.keys[0]).cast("string").alias("business_key"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("except_symmetric_diff", """
SELECT 'source_only' AS side, account_id FROM (SELECT account_id FROM e_account_next EXCEPT SELECT account_id FROM e_account)
UNION ALL SELECT 'target_only', account_id FROM (SELECT account_id FROM e_account EXCEPT SELECT account_id FROM e_account_next)""")
def except_symmetric_diff(lake: Lake) -> DataFrame:
    new, old = lake.snapshot("account", lake.day).select("account_id"), lake.feed("account").select("account_id")
    source_only = new.subtract(old).select(lit("source_only").alias("side"), "account_id")
    return source_only.unionByName(old.subtract(new).select(lit("target_only").alias("side"), "account_id"))


@query("union_by_name_distinct", """
SELECT account_id FROM e_account WHERE account_id % 10 = 1 AND account_id % 17 <> 0 UNION SELECT account_id FROM e_account WHERE account_id % 17 = 0""")
def union_by_name_distinct(lake: Lake) -> DataFrame:
    pairs = classify(lake.baseline("account"), lake.snapshot("account", lake.day), DIMENSIONS["account"])
    changed = pairs.where(col("change") == "changed").select("account_id")
    return changed.unionByName(pairs.where(col("change") == "deleted").select("account_id")).distinct()


@query("unpivot_products", """
SELECT customer_id, 'Credit Card' AS product, has_credit_card AS has_product, no_credit_card AS without_product FROM s_dash UNION ALL
SELECT customer_id, 'Savings', has_savings, no_deposit FROM s_dash UNION ALL SELECT customer_id, 'Loan', has_loan, no_loan FROM s_dash""")
def unpivot_products(lake: Lake) -> DataFrame:
    return lake.dashboard().selectExpr(
        "customer_id",
        "stack(3, 'Credit Card', has_credit_card, no_credit_card, 'Savings', has_savings, no_deposit, 'Loan', has_loan, no_loan) AS (product, has_product, without_product)",
    )


# --- scalar functions ------------------------------------------------------------------------------


@query("fn_date_arith", f"""
SELECT account_id, open_date - 30 AS month_before, date_diff('day', open_date, DATE '{D}') AS days_open, DATE '{D}' AS cob_dt,
  CAST(TIMESTAMP '2024-01-30 08:00:00' AS DATE) AS edit_day FROM e_account""")
def fn_date_arith(lake: Lake) -> DataFrame:
    return lake.feed("account").select(
        "account_id", F.date_add("open_date", -30).alias("month_before"), F.datediff(lit(lake.day), "open_date").alias("days_open"),
        F.to_date(lit("2024-01-30")).alias("cob_dt"), C.ts_lit("2024-01-30 08:00:00").cast("date").alias("edit_day"),
    )


@query("fn_date_parts", "SELECT txn_id, year(txn_date) AS y, month(txn_date) AS m, quarter(txn_date) AS q FROM e_txn")
def fn_date_parts(lake: Lake) -> DataFrame:
    return lake.feed("txn_account").select("txn_id", F.year("txn_date").alias("y"), F.month("txn_date").alias("m"), F.quarter("txn_date").alias("q"))


@query("fn_age", f"""
SELECT customer_id, date_diff('day', date_of_birth, DATE '{D}') // 365 AS age, date_diff('day', date_of_birth, DATE '{D}') // 3650 * 10 AS age_group_decade FROM e_customer""")
def fn_age(lake: Lake) -> DataFrame:
    birth = col("date_of_birth")
    return lake.feed("customer").select("customer_id", C.years_365(birth, lake.day).alias("age"), C.birth_decade(birth, lake.day).alias("age_group_decade"))


@query("fn_timezone_date", "SELECT txn_id, CAST(txn_date + INTERVAL 7 HOUR AS DATE) AS local_day FROM e_card_txn")
def fn_timezone_date(lake: Lake) -> DataFrame:
    """The calendar day in the business zone of an instant stored in UTC."""
    local = F.convert_timezone(lit("UTC"), lit("Asia/Ho_Chi_Minh"), col("txn_date"))
    return lake.feed("card_txn").select("txn_id", local.cast("date").alias("local_day"))


@query("fn_add_months", "SELECT deposit_id, CAST(open_date + to_months(term_months) AS DATE) AS maturity_date FROM e_deposit")
def fn_add_months(lake: Lake) -> DataFrame:
    return lake.feed("deposit").select("deposit_id", F.add_months("open_date", col("term_months")).alias("maturity_date"))


@query("fn_math", """
SELECT txn_id, abs(txn_amount) AS size, CAST(round(txn_amount * 0.001, 1) AS DECIMAL(18,1)) AS thousands, CAST(round(txn_amount / 1000) * 1000 AS BIGINT) AS nearest_thousand,
  CAST(floor(txn_amount) AS BIGINT) AS whole, account_id % 7 AS bucket FROM e_txn""")
def fn_math(lake: Lake) -> DataFrame:
    amount = col("txn_amount")
    return lake.feed("txn_account").select(
        "txn_id", F.abs(amount).alias("size"), F.round(amount / 1000, 1).cast("decimal(18,1)").alias("thousands"),
        F.round(amount, -3).cast("long").alias("nearest_thousand"), F.floor(amount).cast("long").alias("whole"), (col("account_id") % 7).alias("bucket"),
    )


@query("fn_greatest_least", """
SELECT customer_id, greatest(coalesce(a.last_90, TIMESTAMP '1900-01-01'), coalesce(k.last_90, TIMESTAMP '1900-01-01')) AS last_txn,
  greatest(0, least(100, coalesce(a.cnt_90, 0) * 10 - 5)) AS clamped FROM h_cust c LEFT JOIN a_acct a USING (customer_id) LEFT JOIN a_card k USING (customer_id)""")
def fn_greatest_least(lake: Lake) -> DataFrame:
    s = lake.silver()
    a = A.account_activity(s.fact_txn_account, lake.day).select("customer_id", col("last_90").alias("a"), col("cnt_90").alias("n"))
    k = A.card_activity(s.fact_card_txn, lake.day).select("customer_id", col("last_90").alias("k"))
    never = C.ts_lit(C.NEVER_TS)
    return marts.star(asof_dimension(s.dim_customer, lake.day).select("customer_id"), a, k).select(
        "customer_id", F.greatest(F.coalesce("a", never), F.coalesce("k", never)).alias("last_txn"),
        F.greatest(lit(0), F.least(lit(100), F.coalesce("n", lit(0)) * 10 - 5)).alias("clamped"),
    )


@query("fn_null", "SELECT interaction_id, coalesce(status, 'UNKNOWN') AS status, nullif(category, 'COMPLAINT') AS other_category, status IS NULL AS no_status FROM e_crm")
def fn_null(lake: Lake) -> DataFrame:
    return lake.feed("crm_interaction").select(
        "interaction_id", F.coalesce("status", lit("UNKNOWN")).alias("status"), F.nullif(col("category"), lit("COMPLAINT")).alias("other_category"),
        col("status").isNull().alias("no_status"),
    )


@query("fn_string_split_index", """
SELECT customer_id, string_split(full_name, ' ')[1] AS first_word, string_split(full_name, ' ')[3] AS third_word, string_split(full_name, ' ')[-1] AS last_word,
  len(string_split(full_name, ' ')) AS words FROM e_customer""")
def fn_string_split_index(lake: Lake) -> DataFrame:
    words = F.split("full_name", " ")
    return lake.feed("customer").select(
        "customer_id", F.get(words, lit(0)).alias("first_word"), F.get(words, lit(2)).alias("third_word"), F.element_at(words, -1).alias("last_word"),
        F.size(words).alias("words"),
    )


@query("fn_string_basic", """
SELECT customer_id, substr(address, 4, 5) AS part, length(address) AS len, upper(city) || '/' || lower(district) AS place, trim('  ' || gender || ' ') AS gender,
  replace(address, 'Street', 'St') AS short_address, lpad(CAST(customer_id AS VARCHAR), 8, '0') AS padded FROM e_customer""")
def fn_string_basic(lake: Lake) -> DataFrame:
    return lake.feed("customer").select(
        "customer_id", F.substring("address", 4, 5).alias("part"), F.length("address").alias("len"),
        F.concat(F.upper("city"), lit("/"), F.lower("district")).alias("place"), F.trim(F.concat(lit("  "), col("gender"), lit(" "))).alias("gender"),
        F.replace(col("address"), lit("Street"), lit("St")).alias("short_address"), F.lpad(col("customer_id").cast("string"), 8, "0").alias("padded"),
    )


@query("fn_concat_ws_reasons", """
SELECT customer_id, coalesce(nullif(concat_ws('; ', CASE WHEN kyc_status <> 'VERIFIED' THEN 'kyc' END, CASE WHEN email IS NULL THEN 'no email' END,
  CASE WHEN is_active = 0 THEN 'inactive' END), ''), 'fine') AS reasons FROM e_customer""")
def fn_concat_ws_reasons(lake: Lake) -> DataFrame:
    parts = F.concat_ws(
        "; ", F.when(col("kyc_status") != "VERIFIED", "kyc"), F.when(col("email").isNull(), "no email"), F.when(col("is_active") == 0, "inactive")
    )
    return lake.feed("customer").select("customer_id", F.coalesce(F.nullif(parts, lit("")), lit("fine")).alias("reasons"))


@query("fn_sha2_key", f"SELECT account_id, sha256(CAST(account_id AS VARCHAR) || '|{D}') AS account_sk FROM e_account")
def fn_sha2_key(lake: Lake) -> DataFrame:
    return lake.feed("account").select("account_id", C.surrogate_key(["account_id"], lake.day).alias("account_sk"))


@query("fn_salted_hash", "SELECT customer_id, sha256(phone || 'pepper') AS phone_hash FROM e_customer")
def fn_salted_hash(lake: Lake) -> DataFrame:
    return lake.feed("customer").select("customer_id", C.hash_national_id(col("phone"), "pepper").alias("phone_hash"))


@query("fn_array_explode", """
SELECT dim AS table_name, c AS check_name FROM (SELECT DISTINCT dim FROM v_all), unnest(['multiple_current_rows', 'duplicate_surrogate_key', 'invalid_effective_range', 'overlapping_versions']) t(c)""")
def fn_array_explode(lake: Lake) -> DataFrame:
    names = ["multiple_current_rows", "duplicate_surrogate_key", "invalid_effective_range", "overlapping_versions"]
    rows = None
    for entity, spec in DIMENSIONS.items():
        one = lake.dim(entity).select(lit(spec.name).alias("table_name"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.distinct().withColumn("check_name", F.explode(F.array(*[lit(n) for n in names])))


@query("fn_cast_text", "SELECT account_id, CAST(balance AS VARCHAR) AS balance_text, CAST(account_id AS VARCHAR) AS id_text, CAST(open_date AS VARCHAR) AS open_text FROM e_account")
def fn_cast_text(lake: Lake) -> DataFrame:
    return lake.feed("account").select(
        "account_id", col("balance").cast("string").alias("balance_text"), col("account_id").cast("string").alias("id_text"), col("open_date").cast("string").alias("open_text")
    )
