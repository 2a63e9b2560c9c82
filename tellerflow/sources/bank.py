"""The given tables seen as banking feeds.

Every function is a lazy projection (plus the joins the feed needs). Attributes
come from the given columns where they have one to offer (names, market segment,
balances, order status and priority, return and line status, event kind); the
rest is drawn from the row's key, so the feeds are deterministic and grow with
the given tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions.columns import day_lit, ladder, ts_lit

BASE_DAY = dt.date(2024, 1, 29)
COB_DAY = dt.date(2024, 1, 30)
SHIFT_DAYS = 8122  # moves the last shipping date onto COB_DAY
BASE_TS = "2024-01-01 00:00:00"
EDIT_TS = "2024-01-30 08:00:00"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _pick(index: Column, values: list) -> Column:
    """values[index] for a small fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _date_plus(base: str, days: Column) -> Column:
    return F.date_add(day_lit(base), days.cast("int"))


DRAW_BASE = 999_983  # a prime; draws repeat with this period of the key


def draw(key: Column, salt: int, n: int) -> Column:
    """A number below n that the key and the salt decide."""
    mixed = (key.cast("long") % DRAW_BASE) * (104_729 + 15_838 * salt) + 31 * salt
    return mixed % DRAW_BASE % n


def branch(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _text("B", F.lpad(n.cast("string"), 3, "0")).alias("branch_code"),
        _text(F.col("n_name"), " Office").alias("branch_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        _text("Ward ", draw(n, 40, 12)).alias("district"),
        _text(draw(n, 41, 400) + 1, " ", F.initcap("r_name"), " Square").alias("address"),
        _text("Head of ", F.col("n_name")).alias("manager_name"),
        _date_plus("2009-05-04", draw(n, 42, 3000)).alias("open_date"),
        F.lit("ACTIVE").alias("status"),
        ts_lit(BASE_TS).alias("last_updated"),
    )
    return S.conform(rows, S.BRANCH)


def product(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    rows = part.select(
        p.cast("string").alias("product_code"),
        F.col("p_name").alias("product_name"),
        _pick(draw(p, 43, 3), ["DEPOSIT", "LOAN", "CARD"]).alias("product_group"),
        F.col("p_type").alias("product_type"),
        F.lit("VND").alias("currency"),
        (F.col("p_size") > 4).cast("int").alias("is_active"),
        _date_plus("2012-09-01", F.col("p_size") * 30).alias("launch_date"),
        ts_lit(BASE_TS).alias("last_updated"),
    )
    return S.conform(rows, S.PRODUCT)


def customer(customers: DataFrame) -> DataFrame:
    i, balance, words = F.col("c_custkey"), F.col("c_acctbal"), F.split("c_name", "#")
    market = F.initcap("c_mktsegment")
    rows = customers.select(
        i.alias("customer_id"),
        _text(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lpad(i.cast("string"), 12, "0")).alias("cccd"),
        # one, two or three words
        F.when(draw(i, 1, 3) == 0, words[0]).when(draw(i, 1, 3) == 1, F.array_join(words, " "))
        .otherwise(F.concat_ws(" ", market, words[0], words[1])).alias("full_name"),
        F.when(draw(i, 2, 2) == 0, "F").otherwise("M").alias("gender"),
        _date_plus("1950-06-15", draw(i, 3, 20_000)).alias("date_of_birth"),
        F.when(draw(i, 4, 50) != 0, _text("03", F.lpad(draw(i, 5, DRAW_BASE).cast("string"), 8, "0"))).alias("phone"),
        F.when(draw(i, 6, 50) != 0, _text(F.lower(F.array_join(words, ".")), "@", F.lower("c_mktsegment"), ".example")).alias("email"),
        _text(draw(i, 7, 400) + 1, " ", market, " Road").alias("address"),
        _text("City ", draw(i, 8, 9)).alias("city"),
        _text("Ward ", draw(i, 9, 12)).alias("district"),
        _text("B", F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("branch_code"),
        ladder([(balance >= 9000, "VIP"), (balance >= 7000, "PRIORITY")], "RETAIL").alias("customer_segment"),
        ladder([(draw(i, 10, 20) == 0, "REJECTED"), (draw(i, 10, 20) <= 2, "PENDING")], "VERIFIED").alias("kyc_status"),
        _date_plus("2017-03-01", draw(i, 11, 2100)).alias("register_date"),
        (draw(i, 12, 25) != 0).cast("int").alias("is_active"),
        ts_lit(BASE_TS).alias("last_updated"),
    )
    return S.conform(rows, S.CUSTOMER)


def _order_attributes(orders: DataFrame) -> DataFrame:
    """Account-level values every order-derived feed shares."""
    k, balance = F.col("o_orderkey"), (F.col("o_totalprice").cast("decimal(18,2)") * 2000).cast("decimal(18,2)")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        balance.alias("balance"),
        F.col("o_orderdate").cast("date").alias("open_date"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "TIME_DEPOSIT").otherwise("CASA").alias("account_type"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "P", "FROZEN").otherwise("CLOSED").alias("status"),
        draw(k, 20, 200).cast("string").alias("product_code"),
        _text("B", F.lpad(draw(k, 21, 25).cast("string"), 3, "0")).alias("branch_code"),
    )


def account(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rows = _order_attributes(orders).select(
        k.alias("account_id"),
        _text("771", F.lpad(k.cast("string"), 12, "0")).alias("account_no"),
        F.col("o_custkey").alias("customer_id"),
        "product_code",
        "branch_code",
        "account_type",
        F.lit("VND").alias("currency"),
        "balance",
        "open_date",
        F.when(F.col("status") == "CLOSED", F.date_add("open_date", 400)).alias("close_date"),
        "status",
        ts_lit(BASE_TS).alias("last_updated"),
    )
    return S.conform(rows, S.ACCOUNT)


def deposit(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rows = (
        _order_attributes(orders)
        .where(F.col("account_type") == "TIME_DEPOSIT")
        .withColumn("term_months", _pick(draw(k, 22, 5), [2, 4, 9, 18, 30]))
        .select(
            k.alias("deposit_id"),
            k.alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            "product_code",
            (F.col("balance") * F.lit("0.4").cast("decimal(2,1)")).alias("principal_amount"),
            (F.lit(2) + draw(k, 23, 5)).alias("interest_rate"),
            "term_months",
            "open_date",
            F.add_months("open_date", F.col("term_months")).alias("maturity_date"),
            ladder([(draw(k, 24, 20) < 14, "ACTIVE"), (draw(k, 24, 20) < 18, "MATURED")], "EARLY_WITHDRAWN").alias("status"),
            ts_lit(BASE_TS).alias("last_updated"),
        )
    )
    return S.conform(rows, S.DEPOSIT)


def loan(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    state = draw(k, 26, 40)
    rows = (
        _order_attributes(orders)
        .withColumn("term_months", _pick(draw(k, 27, 3), [18, 30, 48]))
        .select(
            k.alias("loan_id"),
            F.col("o_custkey").alias("customer_id"),
            "product_code",
            "branch_code",
            F.col("balance").alias("loan_amount"),
            (F.col("balance") * F.lit("0.3").cast("decimal(2,1)")).alias("outstanding_balance"),
            (F.lit(7) + draw(k, 25, 6)).alias("interest_rate"),
            "term_months",
            F.col("open_date").alias("disbursement_date"),
            F.add_months("open_date", F.col("term_months")).alias("maturity_date"),
            ladder([(state < 24, "ACTIVE"), (state < 32, "CLOSED"), (state < 38, "OVERDUE")], "WRITTEN_OFF").alias("loan_status"),
            ts_lit(BASE_TS).alias("last_updated"),
        )
    )
    return S.conform(rows, S.LOAN)


def card(customers: DataFrame) -> DataFrame:
    i = F.col("c_custkey")
    credit = F.col("c_acctbal") >= 5500
    rows = customers.select(
        i.alias("card_id"),
        _text("5100 **** **** ", F.lpad(draw(i, 13, 10_000).cast("string"), 4, "0")).alias("card_no_masked"),
        i.alias("customer_id"),
        F.when(~credit, i).alias("account_id"),
        F.when(credit, "CC").otherwise("DC").alias("product_code"),
        F.when(credit, "CREDIT").otherwise("DEBIT").alias("card_type"),
        _pick(draw(i, 14, 4), ["JCB", "MASTER", "NAPAS", "VISA"]).alias("card_brand"),
        F.when(credit, (draw(i, 15, 80) + 5) * 1_000_000).alias("credit_limit"),
        _date_plus("2021-07-01", draw(i, 16, 700)).alias("issue_date"),
        _date_plus("2026-02-01", draw(i, 17, 900)).alias("expiry_date"),
        ladder([(draw(i, 18, 20) == 0, "BLOCKED"), (draw(i, 18, 20) == 1, "CLOSED")], "ACTIVE").alias("status"),
        ts_lit(BASE_TS).alias("last_updated"),
    )
    return S.conform(rows, S.CARD)


def txn_account(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    second = draw(F.col("l_partkey"), 29, 86_400).cast("int")
    when = F.expr(f"l_shipdate + INTERVAL '{SHIFT_DAYS}' DAY") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second)
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    rows = (
        lineitem.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("txn_date", when)
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date")).alias(
                "txn_id"
            ),
            F.col("l_orderkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            "txn_date",
            F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("txn_amount"),
            _pick(draw(F.col("l_suppkey") + F.col("l_linenumber"), 28, 6),
                  ["DEPOSIT", "FEE", "INTEREST", "TRANSFER_IN", "TRANSFER_OUT", "WITHDRAWAL"]).alias("txn_type"),
            F.when(F.col("l_linestatus") == "F", "D").otherwise("C").alias("debit_credit"),
            (F.col("l_quantity") * 1000).alias("balance_after"),
            _pick(draw(F.col("l_partkey"), 30, 5), ["ATM", "BRANCH", "INTERNET_BANKING", "MOBILE_BANKING", "POS"]).alias("channel"),
            _text("Order ", F.col("l_orderkey"), " line ", F.col("l_linenumber")).alias("description"),
            F.lit(None).alias("counter_account"),
            F.col("txn_date").alias("created_ts"),
            F.col("txn_date").alias("last_updated"),
        )
    )
    return S.conform(rows, S.TXN_ACCOUNT)


def card_txn(events: DataFrame) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    rows = events.select(
        e.alias("txn_id"),
        F.col("user_id").alias("card_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("txn_date"),
        F.col("value").cast("decimal(18,2)").alias("txn_amount"),
        F.when(kind == "click", "CASH_ADVANCE").when(kind == "signup", "REFUND").otherwise("PURCHASE").alias("txn_type"),
        F.lit("VND").alias("currency"),
        _text("Shop ", draw(e, 31, 120)).alias("merchant_name"),
        _pick(draw(e, 32, 6), ["ECOM", "EDUCATION", "FUEL", "GROCERY", "RESTAURANT", "TRAVEL"]).alias("merchant_category"),
        _pick(draw(e, 33, 3), ["ATM", "ECOM", "POS"]).alias("channel"),
        F.when(kind == "error", "FAILED").when(draw(e, 34, 40) == 0, "PENDING").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("created_ts"),
        F.col("ts").alias("last_updated"),
    )
    return S.conform(rows, S.CARD_TXN)


def crm_interaction(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    state = draw(e, 37, 200)
    rows = events.select(
        e.alias("interaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("interaction_date"),
        _pick(draw(e, 35, 5), ["BRANCH", "CALL", "CHAT", "EMAIL", "SMS"]).alias("channel"),
        F.when(draw(e, 36, 2) == 0, "INBOUND").otherwise("OUTBOUND").alias("direction"),
        _text("About ", F.col("event_type"), " ", e).alias("subject"),
        _pick(draw(e, 38, 5), ["CAMPAIGN", "COMPLAINT", "CROSS_SELL", "INQUIRY", "RETENTION"]).alias("category"),
        F.when(state > 1, "RESOLVED").when(state == 1, "OPEN").alias("status"),
        _text("Desk ", draw(e, 39, 60)).alias("assigned_to"),
        F.col("ts").alias("created_ts"),
        F.col("ts").alias("last_updated"),
    )
    return S.conform(rows, S.CRM)


# --- the second day ------------------------------------------------------------------------------


def _numeric_key(entity: str) -> Column:
    return {
        "branch": F.substr(F.col("branch_code"), F.lit(2)).cast("long"),
        "product": F.col("product_code").cast("long"),
        "customer": F.col("customer_id"),
        "account": F.col("account_id"),
    }[entity]


def _moved_key(entity: str, number: Column) -> tuple[str, Column]:
    new = -number - 1  # given ids are not negative, so this never meets one at any scale
    return {
        "branch": ("branch_code", _text("B", new)),
        "product": ("product_code", new.cast("string")),
        "customer": ("customer_id", new),
        "account": ("account_id", new),
    }[entity]


def _edits(entity: str) -> dict[str, Column]:
    """Business attributes that change on the second day."""
    return {
        "branch": {"manager_name": F.lit("New Manager"), "address": F.lit("New Branch Address"), "status": F.lit("CLOSED")},
        "product": {"product_name": _text(F.col("product_name"), " v2"), "is_active": F.lit(0)},
        "customer": {"phone": F.lit("0988880001"), "address": F.lit("New Customer Address"), "customer_segment": F.lit("PRIORITY")},
        "account": {
            "balance": (F.col("balance") + 1_000_000).cast("decimal(18,2)"),
            "branch_code": F.lit("B002"),
            "status": F.lit("FROZEN"),
        },
    }[entity]


def second_day(entity: str, snapshot: DataFrame, deletes: bool = True) -> DataFrame:
    """Next day's full snapshot: key%10=1 changes, %13=0 touches last_updated only, %17=0 vanishes, %23=0 adds a key.

    One scan: a row that also creates a new key is exploded into two copies.
    """
    key = F.col("_n")
    copies = snapshot.withColumn("_n", _numeric_key(entity)).withColumn(
        "_copy", F.explode(F.when(key % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    original = F.col("_copy") == 0
    if deletes:
        copies = copies.where(~(original & (key % 17 == 0)))
    changed = original & (key % 10 == 1)
    touched = original & ((key % 10 == 1) | (key % 13 == 0))
    columns = {name: F.when(changed, value).otherwise(F.col(name)) for name, value in _edits(entity).items()}
    columns["last_updated"] = F.when(touched, ts_lit(EDIT_TS)).otherwise(F.col("last_updated"))
    name, moved = _moved_key(entity, key)
    columns[name] = F.when(original, columns.get(name, F.col(name))).otherwise(moved)
    return copies.withColumns(columns).select(*snapshot.columns)


def scd1_day(snapshot: DataFrame, key: str, status: str, closed: str, second: bool) -> DataFrame:
    """Two snapshots of a current-state feed: new keys, changed states and vanished keys on the second day."""
    k = F.col(key)
    if not second:
        return snapshot.where(k % 19 != 3)
    changed = k % 10 == 1
    return snapshot.where(k % 29 != 0).withColumns(
        {
            status: F.when(changed, F.lit(closed)).otherwise(F.col(status)),
            "last_updated": F.when(changed, ts_lit(EDIT_TS)).otherwise(F.col("last_updated")),
        }
    )
