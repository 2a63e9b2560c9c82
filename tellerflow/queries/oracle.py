"""The banking model restated in DuckDB SQL over the given tables.

Written independently of the Spark plans and used only to check them. Views are
common table expressions; ``with_views`` puts the ones a query needs in front
of it. Suffix ``_p`` means the day before the processing date.
"""

from __future__ import annotations

import re

P, D = "2024-01-29", "2024-01-30"
OPEN = "DATE '9999-12-31'"
T0, T1 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-30 08:00:00'"

V: dict[str, str] = {}


def pick(index: str, values: list[str]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST({index} AS INTEGER) + 1]"


def draw(key: str, salt: int, n: int) -> str:
    """A number below n that the key and the salt decide."""
    return f"(((CAST({key} AS BIGINT) % 999983) * {104_729 + 15_838 * salt} + {31 * salt}) % 999983 % {n})"


def title(text: str) -> str:
    return f"upper({text}[1]) || lower({text}[2:])"


def half_up(total: str, n: str, scale: int) -> str:
    """total / n rounded half away from zero at a scale, in exact integer arithmetic; total has two decimals."""
    up = 10**scale
    t = f"abs(CAST({total} * 100 AS HUGEINT))"
    q = f"((2 * {up} * {t} + 100 * CAST({n} AS HUGEINT)) // (200 * CAST({n} AS HUGEINT)))"
    return f"CAST(sign({total}) * CAST({q} AS DECIMAL(24,0)) AS DECIMAL(24,0)) * CAST({10.0 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale}))"


def raw_values(view: str, texts: list[str]) -> str:
    """Rows of a view of which a text is the customer's own name, phone, e-mail or national id on the processing date."""
    shown, own = ", ".join(f"s.{c}" for c in texts), "c.full_name, c.phone, c.email, c.cccd"
    present = "list_filter([{}], lambda x: x IS NOT NULL)"
    return (f"(SELECT count(*) FROM {view} s JOIN h_cust c ON s.customer_id = c.customer_id "
            f"WHERE list_has_any({present.format(shown)}, {present.format(own)}))")


# --- feeds of the first day ------------------------------------------------------------------------

V["e_branch"] = f"""
SELECT 'B' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS branch_code, n_name || ' Office' AS branch_name,
  r_name AS region, n_name AS city, 'Ward ' || {draw('n_nationkey', 40, 12)} AS district,
  ({draw('n_nationkey', 41, 400)} + 1) || ' ' || {{region}} || ' Square' AS address, 'Head of ' || n_name AS manager_name,
  DATE '2009-05-04' + CAST({draw('n_nationkey', 42, 3000)} AS INTEGER) AS open_date, 'ACTIVE' AS status, {T0} AS last_updated
FROM nation JOIN region ON n_regionkey = r_regionkey""".replace(
    "{region}", "array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(r_name, ' ')], ' ')"
)

V["e_product"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_code, p_name AS product_name,
  {pick(draw('p_partkey', 43, 3), ['DEPOSIT', 'LOAN', 'CARD'])} AS product_group, p_type AS product_type, 'VND' AS currency,
  CAST(p_size > 4 AS INTEGER) AS is_active, DATE '2012-09-01' + CAST(p_size * 30 AS INTEGER) AS launch_date, {T0} AS last_updated
FROM part"""

V["e_customer"] = f"""
SELECT i AS customer_id, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || lpad(CAST(i AS VARCHAR), 12, '0') AS cccd,
  CASE {draw('i', 1, 3)} WHEN 0 THEN kind WHEN 1 THEN kind || ' ' || number ELSE market || ' ' || kind || ' ' || number END AS full_name,
  CASE {draw('i', 2, 2)} WHEN 0 THEN 'F' ELSE 'M' END AS gender,
  DATE '1950-06-15' + CAST({draw('i', 3, 20000)} AS INTEGER) AS date_of_birth,
  CASE WHEN {draw('i', 4, 50)} > 0 THEN '03' || lpad(CAST({draw('i', 5, 999983)} AS VARCHAR), 8, '0') END AS phone,
  CASE WHEN {draw('i', 6, 50)} > 0 THEN lower(kind || '.' || number) || '@' || lower(c_mktsegment) || '.example' END AS email,
  ({draw('i', 7, 400)} + 1) || ' ' || market || ' Road' AS address, 'City ' || {draw('i', 8, 9)} AS city,
  'Ward ' || {draw('i', 9, 12)} AS district, 'B' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch_code,
  CASE WHEN c_acctbal < 7000 THEN 'RETAIL' WHEN c_acctbal < 9000 THEN 'PRIORITY' ELSE 'VIP' END AS customer_segment,
  CASE WHEN {draw('i', 10, 20)} > 2 THEN 'VERIFIED' WHEN {draw('i', 10, 20)} > 0 THEN 'PENDING' ELSE 'REJECTED' END AS kyc_status,
  DATE '2017-03-01' + CAST({draw('i', 11, 2100)} AS INTEGER) AS register_date, CAST({draw('i', 12, 25)} > 0 AS INTEGER) AS is_active,
  {T0} AS last_updated
FROM (SELECT c_custkey AS i, c_nationkey, c_acctbal, c_mktsegment, {title('c_mktsegment')} AS market,
  split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number FROM customer)"""

V["e_order"] = f"""
SELECT o_orderkey AS k, o_custkey AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2000 AS DECIMAL(18,2)) AS balance,
  CAST(o_orderdate AS DATE) AS open_date,
  CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'TIME_DEPOSIT' ELSE 'CASA' END AS account_type,
  CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'FROZEN' ELSE 'CLOSED' END AS status,
  CAST({draw('o_orderkey', 20, 200)} AS VARCHAR) AS product_code,
  'B' || lpad(CAST({draw('o_orderkey', 21, 25)} AS VARCHAR), 3, '0') AS branch_code
FROM orders"""

V["e_account"] = f"""
SELECT k AS account_id, '771' || lpad(CAST(k AS VARCHAR), 12, '0') AS account_no, customer_id, product_code, branch_code,
  account_type, 'VND' AS currency, balance, open_date, CASE status WHEN 'CLOSED' THEN open_date + 400 END AS close_date,
  status, {T0} AS last_updated
FROM e_order"""

V["e_deposit"] = f"""
SELECT k AS deposit_id, k AS account_id, customer_id, product_code, CAST(balance * 0.4 AS DECIMAL(18,2)) AS principal_amount,
  CAST(2 + {draw('k', 23, 5)} AS DECIMAL(5,2)) AS interest_rate, term AS term_months, open_date,
  CAST(open_date + to_months(term) AS DATE) AS maturity_date,
  CASE WHEN {draw('k', 24, 20)} > 17 THEN 'EARLY_WITHDRAWN' WHEN {draw('k', 24, 20)} > 13 THEN 'MATURED' ELSE 'ACTIVE' END AS status, {T0} AS last_updated
FROM (SELECT *, [2, 4, 9, 18, 30][CAST({draw('k', 22, 5)} AS INTEGER) + 1] AS term FROM e_order WHERE account_type = 'TIME_DEPOSIT')"""

V["e_loan"] = f"""
SELECT k AS loan_id, customer_id, product_code, branch_code, balance AS loan_amount,
  CAST(balance * 0.3 AS DECIMAL(18,2)) AS outstanding_balance, CAST(7 + {draw('k', 25, 6)} AS DECIMAL(5,2)) AS interest_rate,
  term AS term_months, open_date AS disbursement_date, CAST(open_date + to_months(term) AS DATE) AS maturity_date,
  CASE WHEN s > 37 THEN 'WRITTEN_OFF' WHEN s > 31 THEN 'OVERDUE' WHEN s > 23 THEN 'CLOSED' ELSE 'ACTIVE' END AS loan_status,
  {T0} AS last_updated
FROM (SELECT *, {draw('k', 26, 40)} AS s, [18, 30, 48][CAST({draw('k', 27, 3)} AS INTEGER) + 1] AS term FROM e_order)"""

V["e_card"] = f"""
SELECT i AS card_id, '5100 **** **** ' || lpad(CAST({draw('i', 13, 10000)} AS VARCHAR), 4, '0') AS card_no_masked,
  i AS customer_id, CASE WHEN NOT credit THEN i END AS account_id, CASE WHEN credit THEN 'CC' ELSE 'DC' END AS product_code,
  CASE WHEN credit THEN 'CREDIT' ELSE 'DEBIT' END AS card_type, {pick(draw('i', 14, 4), ['JCB', 'MASTER', 'NAPAS', 'VISA'])} AS card_brand,
  CASE WHEN credit THEN CAST(({draw('i', 15, 80)} + 5) * 1000000 AS DECIMAL(18,2)) END AS credit_limit,
  DATE '2021-07-01' + CAST({draw('i', 16, 700)} AS INTEGER) AS issue_date, DATE '2026-02-01' + CAST({draw('i', 17, 900)} AS INTEGER) AS expiry_date,
  CASE {draw('i', 18, 20)} WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'CLOSED' ELSE 'ACTIVE' END AS status, {T0} AS last_updated
FROM (SELECT c_custkey AS i, c_acctbal >= 5500 AS credit FROM customer)"""

V["e_txn"] = f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE) AS txn_id,
  l_orderkey AS account_id, o_custkey AS customer_id, l_shipdate + to_days(8122) + to_seconds({draw('l_partkey', 29, 86400)}) AS txn_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS txn_amount,
  {pick(draw('l_suppkey + l_linenumber', 28, 6), ['DEPOSIT', 'FEE', 'INTEREST', 'TRANSFER_IN', 'TRANSFER_OUT', 'WITHDRAWAL'])} AS txn_type,
  CASE l_linestatus WHEN 'F' THEN 'D' ELSE 'C' END AS debit_credit, CAST(l_quantity * 1000 AS DECIMAL(18,2)) AS balance_after,
  {pick(draw('l_partkey', 30, 5), ['ATM', 'BRANCH', 'INTERNET_BANKING', 'MOBILE_BANKING', 'POS'])} AS channel,
  'Order ' || l_orderkey || ' line ' || l_linenumber AS description, CAST(NULL AS VARCHAR) AS counter_account
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

V["e_card_txn"] = f"""
SELECT event_id AS txn_id, user_id AS card_id, user_id AS customer_id, ts AS txn_date, CAST(value AS DECIMAL(18,2)) AS txn_amount,
  CASE event_type WHEN 'click' THEN 'CASH_ADVANCE' WHEN 'signup' THEN 'REFUND' ELSE 'PURCHASE' END AS txn_type, 'VND' AS currency,
  'Shop ' || {draw('event_id', 31, 120)} AS merchant_name,
  {pick(draw('event_id', 32, 6), ['ECOM', 'EDUCATION', 'FUEL', 'GROCERY', 'RESTAURANT', 'TRAVEL'])} AS merchant_category,
  {pick(draw('event_id', 33, 3), ['ATM', 'ECOM', 'POS'])} AS channel,
  CASE WHEN event_type = 'error' THEN 'FAILED' WHEN {draw('event_id', 34, 40)} = 0 THEN 'PENDING' ELSE 'SUCCESS' END AS status
FROM events"""

V["e_crm"] = f"""
SELECT event_id AS interaction_id, user_id AS customer_id, ts AS interaction_date,
  {pick(draw('event_id', 35, 5), ['BRANCH', 'CALL', 'CHAT', 'EMAIL', 'SMS'])} AS channel,
  CASE {draw('event_id', 36, 2)} WHEN 0 THEN 'INBOUND' ELSE 'OUTBOUND' END AS direction, 'About ' || event_type || ' ' || event_id AS subject,
  {pick(draw('event_id', 38, 5), ['CAMPAIGN', 'COMPLAINT', 'CROSS_SELL', 'INQUIRY', 'RETENTION'])} AS category,
  CASE {draw('event_id', 37, 200)} WHEN 0 THEN NULL WHEN 1 THEN 'OPEN' ELSE 'RESOLVED' END AS status,
  'Desk ' || {draw('event_id', 39, 60)} AS assigned_to
FROM events"""

# --- second day and versioned dimensions -----------------------------------------------------------

COLUMNS = {
    "branch": "branch_code branch_name region city district address manager_name open_date status last_updated".split(),
    "product": "product_code product_name product_group product_type currency is_active launch_date last_updated".split(),
    "customer": (
        "customer_id cccd full_name gender date_of_birth phone email address city district branch_code "
        "customer_segment kyc_status register_date is_active last_updated"
    ).split(),
    "account": (
        "account_id account_no customer_id product_code branch_code account_type currency balance open_date close_date "
        "status last_updated"
    ).split(),
}
_NUM = {
    "branch": "CAST(substr(branch_code, 2) AS BIGINT)", "product": "CAST(product_code AS BIGINT)",
    "customer": "customer_id", "account": "account_id",
}
_NEW = {
    "branch": "'B' || (-n - 1)", "product": "CAST(-n - 1 AS VARCHAR)", "customer": "-n - 1", "account": "-n - 1",
}
_EDIT = {
    "branch": {"manager_name": "'New Manager'", "address": "'New Branch Address'", "status": "'CLOSED'"},
    "product": {"product_name": "product_name || ' v2'", "is_active": "0"},
    "customer": {"phone": "'0988880001'", "address": "'New Customer Address'", "customer_segment": "'PRIORITY'"},
    "account": {"balance": "CAST(balance + 1000000 AS DECIMAL(18,2))", "branch_code": "'B002'", "status": "'FROZEN'"},
}
for _e, _cols in COLUMNS.items():
    _key = _cols[0]
    _edited = [
        f"CASE WHEN n % 10 = 1 THEN {_EDIT[_e][c]} ELSE {c} END AS {c}" if c in _EDIT[_e]
        else f"CASE WHEN n % 10 = 1 OR n % 13 = 0 THEN {T1} ELSE {c} END AS {c}" if c == "last_updated" else c
        for c in _cols
    ]
    _same = [f"{_NEW[_e]} AS {c}" if c == _key else c for c in _cols]
    V[f"e_{_e}_next"] = f"""
SELECT {', '.join(_edited)} FROM (SELECT *, {_NUM[_e]} AS n FROM e_{_e}) WHERE n % 17 <> 0
UNION ALL SELECT {', '.join(_same)} FROM (SELECT *, {_NUM[_e]} AS n FROM e_{_e}) WHERE n % 23 = 0"""
    _diff = " OR ".join(f"b.{c} IS DISTINCT FROM s.{c}" for c in _cols[1:-1])
    _sk = lambda a, day: f"sha256(CAST({a}.{_key} AS VARCHAR) || '|{day}')"
    V[f"d_{_e}"] = f"""
SELECT b.*, DATE '{P}' AS effective_from, CASE WHEN s.{_key} IS NULL OR {_diff} THEN DATE '{P}' ELSE {OPEN} END AS effective_to,
  CASE WHEN s.{_key} IS NULL OR {_diff} THEN 0 ELSE 1 END AS is_current, {_sk('b', P)} AS {_e}_sk
FROM e_{_e} b LEFT JOIN e_{_e}_next s ON b.{_key} = s.{_key}
UNION ALL
SELECT s.*, DATE '{D}', {OPEN}, 1, {_sk('s', D)} FROM e_{_e}_next s LEFT JOIN e_{_e} b ON b.{_key} = s.{_key}
WHERE b.{_key} IS NULL OR {_diff}"""

for _e, _key, _status, _to in (
    ("deposit", "deposit_id", "status", "MATURED"), ("loan", "loan_id", "loan_status", "OVERDUE"), ("card", "card_id", "status", "BLOCKED"),
):
    V[f"e_{_e}_first"] = f"SELECT * FROM e_{_e} WHERE {_key} % 19 <> 3"
    V[f"e_{_e}_next"] = f"""
SELECT * REPLACE (CASE WHEN {_key} % 10 = 1 THEN '{_to}' ELSE {_status} END AS {_status},
  CASE WHEN {_key} % 10 = 1 THEN {T1} ELSE last_updated END AS last_updated) FROM e_{_e} WHERE {_key} % 29 <> 0"""
    V[f"d_{_e}"] = f"""
SELECT * FROM e_{_e}_next UNION ALL SELECT * FROM e_{_e}_first WHERE {_key} NOT IN (SELECT {_key} FROM e_{_e}_next)"""

# --- facts -----------------------------------------------------------------------------------------


def _version_at(dim: str, alias: str, event: str) -> str:
    first = f"(SELECT min(effective_from) OVER (PARTITION BY {dim}_id) AS first_from, {dim}_id AS vk, {dim}_sk, effective_from AS vf, effective_to AS vt FROM d_{dim})"
    at = f"CAST({event} AS DATE)"
    return (
        f"LEFT JOIN {first} {alias} ON {alias}.vk = t.{dim}_id AND ({at} BETWEEN {alias}.vf AND {alias}.vt "
        f"OR ({at} < {alias}.first_from AND {alias}.vf = {alias}.first_from))"
    )


V["f_acct"] = f"""
SELECT t.txn_id, t.account_id, a.account_sk, t.customer_id, c.customer_sk, t.txn_date, t.txn_amount, t.txn_type, t.debit_credit,
  t.balance_after, t.channel, t.description, t.counter_account, t.txn_date AS created_ts, CAST(t.txn_date AS DATE) AS cob_dt
FROM e_txn t {_version_at('account', 'a', 't.txn_date')} {_version_at('customer', 'c', 't.txn_date')}"""
V["f_card"] = f"""
SELECT t.txn_id, t.card_id, t.customer_id, c.customer_sk, t.txn_date, t.txn_amount, t.txn_type, t.currency, t.merchant_name,
  t.merchant_category, t.channel, t.status, t.txn_date AS created_ts, CAST(t.txn_date AS DATE) AS cob_dt
FROM e_card_txn t {_version_at('customer', 'c', 't.txn_date')}"""
V["f_crm"] = f"""
SELECT t.interaction_id, t.customer_id, c.customer_sk, t.interaction_date, t.channel, t.direction, t.subject, t.category, t.status,
  t.assigned_to, t.interaction_date AS created_ts, CAST(t.interaction_date AS DATE) AS cob_dt
FROM e_crm t {_version_at('customer', 'c', 't.interaction_date')}"""

# --- per-customer aggregates and gold tables, for both days ----------------------------------------

GOOD_CARD = "status = 'SUCCESS' AND txn_type <> 'REFUND' AND txn_type <> 'REVERSAL'"
SEGMENT = """CASE WHEN frequency = 0 THEN 'Lost' WHEN r_score < 3 AND greatest(f_score, m_score) > 2 THEN 'At Risk'
  WHEN rfm_score > 12 THEN 'Champions' WHEN rfm_score > 9 THEN 'Loyal Customers' WHEN r_score > 3 AND f_score < 3 THEN 'New Customers'
  WHEN rfm_score > 7 THEN 'Potential Loyalists' WHEN rfm_score > 3 THEN 'Hibernating' ELSE 'Lost' END"""


def _activity(fact: str, event: str, amount: str, where: str, day: str, extra: str = "") -> str:
    parts = []
    for n in (30, 90, 365):
        inside = f"FILTER (WHERE age <= {n})"
        parts.append(
            f"count(*) {inside} AS cnt_{n}, coalesce(sum({amount}) {inside}, 0) AS amt_{n}, max({event}) {inside} AS last_{n}"
        )
    return f"""
SELECT customer_id, {', '.join(parts)}{extra}
FROM (SELECT *, date_diff('day', CAST({event} AS DATE), DATE '{day}') AS age FROM {fact} WHERE {where}) WHERE age BETWEEN 0 AND 365
GROUP BY customer_id"""


for _s, _d in (("", D), ("_p", P)):
    V[f"h_cust{_s}"] = f"SELECT * FROM d_customer WHERE effective_from <= DATE '{_d}' AND effective_to >= DATE '{_d}'"
    V[f"h_acct{_s}"] = f"""
SELECT customer_id, count(*) AS accounts, count(*) FILTER (WHERE status = 'ACTIVE' AND account_type = 'CASA') AS casa,
  count(*) FILTER (WHERE status = 'ACTIVE' AND account_type = 'TIME_DEPOSIT') AS td, count(*) FILTER (WHERE status = 'ACTIVE') AS n_active,
  coalesce(sum(balance) FILTER (WHERE status = 'ACTIVE'), 0) AS bal
FROM d_account WHERE effective_from <= DATE '{_d}' AND effective_to >= DATE '{_d}' GROUP BY customer_id"""
    V[f"a_acct{_s}"] = _activity(
        "f_acct", "txn_date", "abs(txn_amount)", "true", _d,
        ", count(*) FILTER (WHERE age <= 30 AND debit_credit = 'C') AS c_cnt, count(*) FILTER (WHERE age <= 30 AND debit_credit = 'D') AS d_cnt"
        ", coalesce(sum(txn_amount) FILTER (WHERE age <= 30 AND debit_credit = 'C'), 0) AS c_amt"
        ", coalesce(sum(abs(txn_amount)) FILTER (WHERE age <= 30 AND debit_credit = 'D'), 0) AS d_amt",
    )
    V[f"a_card{_s}"] = _activity(
        "f_card", "txn_date", "txn_amount", GOOD_CARD, _d, ", count(DISTINCT merchant_category) FILTER (WHERE age <= 30) AS cats"
    )
    V[f"a_both{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, {', '.join(f"coalesce(a.{m}_{n}, 0) + coalesce(k.{m}_{n}, 0) AS {m}_{n}" for n in (30, 90, 365) for m in ('cnt', 'amt'))},
  {', '.join(f"greatest(a.last_{n}, k.last_{n}) AS last_{n}" for n in (30, 90, 365))}
FROM h_cust{_s} c LEFT JOIN a_acct{_s} a USING (customer_id) LEFT JOIN a_card{_s} k USING (customer_id)"""
    V[f"a_channel{_s}"] = f"""
SELECT customer_id, channel AS primary_channel FROM (
  SELECT customer_id, channel, count(*) AS n FROM f_acct WHERE cob_dt BETWEEN DATE '{_d}' - 30 AND DATE '{_d}' GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, channel) = 1"""
    V[f"a_crm{_s}"] = f"""
SELECT customer_id, count(*) AS n, max(interaction_date) AS last_at FROM f_crm
WHERE cob_dt BETWEEN DATE '{_d}' - 90 AND DATE '{_d}' GROUP BY customer_id"""
    V[f"a_open{_s}"] = f"""
SELECT customer_id, count(*) AS n FROM f_crm
WHERE cob_dt <= DATE '{_d}' AND category = 'COMPLAINT' AND coalesce(status, '?') <> 'RESOLVED' GROUP BY customer_id"""
    V[f"g_balance{_s}"] = f"""
SELECT customer_id, customer_sk, CAST(b AS DECIMAL(18,2)) AS total_account_balance,
  CAST(CASE WHEN n_active > 0 THEN {half_up('b', 'n_active', 2)} ELSE 0 END AS DECIMAL(18,2)) AS avg_account_balance,
  CAST(p AS DECIMAL(18,2)) AS total_deposit_principal, CAST(o AS DECIMAL(18,2)) AS total_loan_outstanding,
  CAST(b + p AS DECIMAL(18,2)) AS aum_total, CAST(b + p - o AS DECIMAL(18,2)) AS net_worth, DATE '{_d}' AS cob_dt
FROM (SELECT c.customer_id, c.customer_sk, coalesce(a.bal, 0) AS b, a.n_active, coalesce(d.principal, 0) AS p, coalesce(l.owed, 0) AS o
  FROM h_cust{_s} c LEFT JOIN h_acct{_s} a USING (customer_id) LEFT JOIN h_dep d USING (customer_id) LEFT JOIN h_loan l USING (customer_id))"""
    V[f"g_product{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, coalesce(a.accounts, 0) AS total_accounts, coalesce(a.casa, 0) AS cnt_casa_active,
  coalesce(a.td, 0) AS cnt_td_active, coalesce(d.n, 0) AS cnt_deposits, coalesce(d.n_active, 0) AS cnt_deposits_active,
  coalesce(l.n, 0) AS cnt_loans, coalesce(l.n_active, 0) AS cnt_loans_active, coalesce(k.n, 0) AS cnt_cards,
  coalesce(k.credit, 0) AS cnt_credit_cards, coalesce(k.debit, 0) AS cnt_debit_cards,
  CAST(coalesce(k.credit, 0) > 0 AS INTEGER) AS has_credit_card, CAST(coalesce(d.n_active, 0) > 0 AS INTEGER) AS has_savings,
  CAST(coalesce(l.n_active, 0) > 0 AS INTEGER) AS has_loan, DATE '{_d}' AS cob_dt
FROM h_cust{_s} c LEFT JOIN h_acct{_s} a USING (customer_id) LEFT JOIN h_dep d USING (customer_id) LEFT JOIN h_loan l USING (customer_id)
LEFT JOIN h_card k USING (customer_id)"""
    V[f"g_card{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, coalesce(k.n, 0) AS total_cards, coalesce(k.credit, 0) AS cnt_credit_active,
  coalesce(k.debit, 0) AS cnt_debit_active, CAST(coalesce(k.top_limit, 0) AS DECIMAL(18,2)) AS max_credit_limit,
  coalesce(t.cnt_30, 0) AS total_card_txn_count_30d, CAST(coalesce(t.amt_30, 0) AS DECIMAL(18,2)) AS total_card_txn_amount_30d,
  CAST(CASE WHEN t.cnt_30 > 0 THEN {half_up('t.amt_30', 't.cnt_30', 2)} ELSE 0 END AS DECIMAL(18,2)) AS avg_card_txn_amount_30d,
  coalesce(t.cats, 0) AS distinct_merchant_categories, t.last_30 AS last_card_txn_date, DATE '{_d}' AS cob_dt
FROM h_cust{_s} c LEFT JOIN h_card k USING (customer_id) LEFT JOIN a_card{_s} t USING (customer_id)"""
    V[f"g_txn{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, coalesce(a.cnt_30, 0) AS acct_txn_count_30d, CAST(coalesce(a.amt_30, 0) AS DECIMAL(18,2)) AS acct_txn_amount_30d,
  coalesce(a.c_cnt, 0) AS acct_credit_count_30d, coalesce(a.d_cnt, 0) AS acct_debit_count_30d,
  CAST(coalesce(a.c_amt, 0) AS DECIMAL(18,2)) AS acct_credit_amount_30d, CAST(coalesce(a.d_amt, 0) AS DECIMAL(18,2)) AS acct_debit_amount_30d,
  coalesce(k.cnt_30, 0) AS card_txn_count_30d, CAST(coalesce(k.amt_30, 0) AS DECIMAL(18,2)) AS card_txn_amount_30d,
  c.cnt_30 AS total_txn_count_30d, CAST(c.amt_30 AS DECIMAL(18,2)) AS total_txn_amount_30d,
  coalesce(c.last_30, TIMESTAMP '1900-01-01 00:00:00') AS last_txn_date, DATE '{_d}' AS cob_dt
FROM a_both{_s} c LEFT JOIN a_acct{_s} a USING (customer_id) LEFT JOIN a_card{_s} k USING (customer_id)"""
    V[f"g_rank{_s}"] = f"""
SELECT customer_id, ntile(5) OVER (ORDER BY last_at_days DESC, customer_id) AS r, ntile(5) OVER (ORDER BY cnt_90, customer_id) AS f,
  ntile(5) OVER (ORDER BY amt_90, customer_id) AS m
FROM (SELECT *, date_diff('day', CAST(last_90 AS DATE), DATE '{_d}') AS last_at_days FROM a_both{_s} WHERE cnt_90 > 0)"""
    V[f"g_rfm{_s}"] = f"""
SELECT *, {SEGMENT} AS rfm_segment, DATE '{_d}' AS cob_dt FROM (
  SELECT b.customer_id, b.customer_sk, coalesce(date_diff('day', CAST(b.last_90 AS DATE), DATE '{_d}'), 99999) AS recency_days,
    b.cnt_90 AS frequency, CAST(b.amt_90 AS DECIMAL(18,2)) AS monetary, coalesce(r.r, 1) AS r_score, coalesce(r.f, 1) AS f_score,
    coalesce(r.m, 1) AS m_score, coalesce(r.r, 1) + coalesce(r.f, 1) + coalesce(r.m, 1) AS rfm_score
  FROM a_both{_s} b LEFT JOIN g_rank{_s} r USING (customer_id))"""
    V[f"g_churn{_s}"] = f"""
SELECT customer_id, customer_sk, cnt_30 AS txn_cnt_30d, cnt_90 AS txn_cnt_90d, CAST(amt_30 AS DECIMAL(18,2)) AS txn_amt_30d,
  CAST(amt_90 AS DECIMAL(18,2)) AS txn_amt_90d, idle AS days_since_last_txn,
  CASE WHEN idle <= 30 THEN 'Active' WHEN idle <= 60 THEN 'Low' WHEN idle <= 90 THEN 'Medium' ELSE 'High' END AS churn_risk,
  CAST(idle > 90 AS INTEGER) AS is_churn_candidate, DATE '{_d}' AS cob_dt
FROM (SELECT *, date_diff('day', CAST(coalesce(last_365, TIMESTAMP '1900-01-01') AS DATE), DATE '{_d}') AS idle FROM a_both{_s})"""
    V[f"g_cross{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, c.customer_segment, 1 - p.has_credit_card AS no_credit_card, 1 - p.has_savings AS no_deposit,
  1 - p.has_loan AS no_loan,
  CASE WHEN p.has_credit_card = 0 THEN 'Credit Card' WHEN p.has_savings = 0 THEN 'Deposit' WHEN p.has_loan = 0 THEN 'Loan' ELSE 'None' END AS primary_opportunity,
  DATE '{_d}' AS cob_dt
FROM h_cust{_s} c JOIN g_product{_s} p USING (customer_id)"""
    V[f"g_mart{_s}"] = f"""
SELECT c.customer_id, c.customer_sk, string_split(c.full_name, ' ')[1] || ' **' AS full_name_masked,
  CAST(date_diff('day', c.date_of_birth, DATE '{_d}') // 365 AS INTEGER) AS age, c.gender, c.branch_code AS primary_branch_code,
  c.customer_segment, c.kyc_status, c.register_date, p.total_accounts, p.cnt_cards AS total_cards, p.cnt_loans AS total_loans,
  p.has_credit_card, p.has_savings, p.has_loan, b.aum_total AS total_deposit_balance, b.total_loan_outstanding, b.aum_total,
  CASE WHEN b.aum_total < 100000000 THEN 'MASS' WHEN b.aum_total < 1000000000 THEN 'AFFLUENT' WHEN b.aum_total < 5000000000 THEN 'PRIORITY' ELSE 'VIP' END AS aum_bucket,
  t.cnt_30 AS txn_count_30d, CAST(t.amt_30 AS DECIMAL(18,2)) AS txn_amount_30d, t.last_365 AS last_txn_date,
  coalesce(date_diff('day', CAST(t.last_365 AS DATE), DATE '{_d}'), 99999) AS days_since_last_txn,
  coalesce(ch.primary_channel, 'UNKNOWN') AS primary_channel, coalesce(m.n, 0) AS interaction_count_90d, m.last_at AS last_interaction_date,
  r.r_score AS rfm_recency_score, r.f_score AS rfm_frequency_score, r.m_score AS rfm_monetary_score, r.rfm_segment,
  CAST(coalesce(date_diff('day', CAST(t.last_365 AS DATE), DATE '{_d}'), 99999) > 90 AS INTEGER) AS churn_flag,
  CAST(b.aum_total >= 100000000 AND p.has_credit_card = 0 AS INTEGER) AS cross_sell_credit_card_flag, DATE '{_d}' AS cob_dt
FROM h_cust{_s} c JOIN g_product{_s} p USING (customer_id) JOIN g_balance{_s} b USING (customer_id) JOIN a_both{_s} t USING (customer_id)
JOIN g_rfm{_s} r USING (customer_id) LEFT JOIN a_channel{_s} ch USING (customer_id) LEFT JOIN a_crm{_s} m USING (customer_id)"""
    V[f"g_offer{_s}"] = f"""
SELECT r.customer_id, r.customer_sk, r.rfm_segment, r.rfm_score, r.recency_days, r.frequency, r.monetary, h.churn_risk, h.is_churn_candidate,
  h.days_since_last_txn, m.customer_segment, m.kyc_status, m.aum_total, m.aum_bucket, m.primary_branch_code, x.primary_opportunity,
  x.no_credit_card, x.no_deposit, x.no_loan, m.kyc_status <> 'VERIFIED' AS bad_kyc, coalesce(o.n, 0) > 0 AS complains,
  h.churn_risk = 'High' AS leaving, r.rfm_segment IN ('Champions', 'Loyal Customers') AS valued,
  m.customer_segment <> 'RETAIL' AS premium, m.aum_total >= 100000000 AS rich, h.days_since_last_txn <= 30 AS fresh,
  h.is_churn_candidate = 1 AND r.rfm_segment IN ('At Risk', 'Hibernating') AS retain, DATE '{_d}' AS cob_dt
FROM g_rfm{_s} r JOIN g_churn{_s} h USING (customer_id) JOIN g_cross{_s} x USING (customer_id) JOIN g_mart{_s} m USING (customer_id)
LEFT JOIN a_open{_s} o USING (customer_id)"""
    V[f"g_score{_s}"] = f"""
SELECT *, CAST(greatest(0, least(100, 30 * no_credit_card + 25 * rich::INT + 20 * valued::INT + 15 * fresh::INT + 10 * premium::INT
    - 30 * bad_kyc::INT - 20 * (leaving OR complains)::INT)) AS INTEGER) AS cross_sell_score,
  CASE WHEN retain THEN 'RETENTION_OFFER' WHEN no_credit_card = 1 THEN 'CREDIT_CARD' WHEN no_deposit = 1 THEN 'TERM_DEPOSIT'
    WHEN no_loan = 1 THEN 'PERSONAL_LOAN' WHEN premium THEN 'WEALTH_MANAGEMENT' ELSE 'DIGITAL_SAVINGS' END AS recommended_product,
  concat_ws('; ',
    CASE no_credit_card WHEN 1 THEN 'No credit card (+30)' END, CASE WHEN rich THEN 'AUM at least 100m (+25)' END,
    CASE WHEN valued THEN 'High-value RFM (+20)' END, CASE WHEN fresh THEN 'Active in last 30 days (+15)' END,
    CASE WHEN premium THEN 'Priority/VIP (+10)' END, CASE WHEN bad_kyc THEN 'KYC not verified (-30)' END,
    CASE WHEN leaving AND complains THEN 'High churn risk and open complaint (-20)' WHEN leaving THEN 'High churn risk (-20)'
      WHEN complains THEN 'Open complaint (-20)' END) AS why
FROM g_offer{_s}"""
    V[f"g_campaign{_s}"] = f"""
SELECT customer_id, customer_sk, rfm_segment, rfm_score, recency_days, frequency, monetary, churn_risk, is_churn_candidate, days_since_last_txn,
  customer_segment, aum_total, aum_bucket, primary_branch_code, primary_opportunity, no_credit_card, no_deposit, no_loan, cross_sell_score,
  recommended_product, CASE WHEN why = '' THEN 'Baseline product fit' ELSE why END AS recommendation_reason,
  CASE WHEN bad_kyc OR complains OR cross_sell_score < 40 THEN 'LOW' WHEN cross_sell_score < 70 THEN 'MEDIUM' ELSE 'HIGH' END AS campaign_priority,
  CAST(NOT (bad_kyc OR complains) AS INTEGER) AS contact_eligible_flag,
  CASE WHEN bad_kyc THEN 'KYC_NOT_VERIFIED' WHEN complains THEN 'OPEN_COMPLAINT' END AS suppression_reason,
  CASE WHEN retain THEN 'Retention' WHEN recommended_product = 'CREDIT_CARD' THEN 'Cross_Sell_CC'
    WHEN recommended_product IN ('TERM_DEPOSIT', 'PERSONAL_LOAN') THEN 'Cross_Sell' WHEN valued THEN 'Upsell' ELSE 'Awareness' END AS campaign_type,
  cob_dt
FROM g_score{_s}"""

V["h_dep"] = """
SELECT customer_id, count(*) AS n, count(*) FILTER (WHERE status = 'ACTIVE') AS n_active,
  coalesce(sum(principal_amount) FILTER (WHERE status = 'ACTIVE'), 0) AS principal FROM d_deposit GROUP BY customer_id"""
V["h_loan"] = """
SELECT customer_id, count(*) AS n, count(*) FILTER (WHERE loan_status = 'ACTIVE') AS n_active,
  coalesce(sum(outstanding_balance) FILTER (WHERE loan_status = 'ACTIVE'), 0) AS owed FROM d_loan GROUP BY customer_id"""
V["h_card"] = """
SELECT customer_id, count(*) AS n, count(*) FILTER (WHERE status = 'ACTIVE' AND card_type = 'CREDIT') AS credit,
  count(*) FILTER (WHERE status = 'ACTIVE' AND card_type = 'DEBIT') AS debit, max(credit_limit) AS top_limit FROM d_card GROUP BY customer_id"""

for _n in ("balance", "product", "card", "txn", "rfm", "churn", "cross", "mart", "campaign"):
    V[f"gg_{_n}"] = f"SELECT * FROM g_{_n} UNION ALL SELECT * FROM g_{_n}_p"

V["b_rows"] = """
SELECT a.branch_code, year(t.txn_date) AS txn_year, month(t.txn_date) AS txn_month, t.* FROM f_acct t JOIN d_account a
ON a.account_id = t.account_id AND t.cob_dt >= a.effective_from AND t.cob_dt <= a.effective_to"""
V["g_branch"] = f"""
SELECT m.branch_code, b.branch_name, b.region, b.city, m.txn_year, m.txn_month, (m.txn_month + 2) // 3 AS txn_quarter, m.active_customers, m.txn_count,
  CAST(m.total AS DECIMAL(18,2)) AS total_txn_amount, CAST({half_up('m.total', 'm.txn_count', 2)} AS DECIMAL(18,2)) AS avg_txn_amount,
  CAST(m.credit AS DECIMAL(18,2)) AS total_credit_amount, CAST(m.debit AS DECIMAL(18,2)) AS total_debit_amount, t.channel AS top_channel,
  DATE '{D}' AS cob_dt
FROM (SELECT branch_code, txn_year, txn_month, count(DISTINCT customer_id) AS active_customers, count(*) AS txn_count, sum(abs(txn_amount)) AS total,
    coalesce(sum(txn_amount) FILTER (WHERE debit_credit = 'C'), 0) AS credit, coalesce(sum(txn_amount) FILTER (WHERE debit_credit = 'D'), 0) AS debit
  FROM b_rows GROUP BY ALL) m
LEFT JOIN (SELECT branch_code, txn_year, txn_month, channel FROM b_rows GROUP BY branch_code, txn_year, txn_month, channel
  QUALIFY row_number() OVER (PARTITION BY branch_code, txn_year, txn_month ORDER BY count(*) DESC, channel) = 1) t USING (branch_code, txn_year, txn_month)
LEFT JOIN (SELECT * FROM d_branch WHERE effective_from <= DATE '{D}' AND effective_to >= DATE '{D}') b USING (branch_code)"""

V["b_all"] = """
SELECT a.branch_code, year(f.txn_date) AS txn_year, month(f.txn_date) AS txn_month, f.customer_id, f.channel, f.txn_amount, f.debit_credit
FROM f_acct f JOIN d_account a USING (account_sk)"""
V["g_branch_all"] = V["g_branch"].replace("b_rows", "b_all")

V["s_dash"] = """
SELECT m.* EXCLUDE (cob_dt),
  CASE WHEN m.age IS NULL THEN 'UNKNOWN' WHEN m.age >= 65 THEN '65+' WHEN m.age < 25 THEN '18-24'
    ELSE ((m.age + 5) // 10 * 10 - 5) || '-' || ((m.age + 5) // 10 * 10 + 4) END AS age_group,
  c.churn_risk, c.is_churn_candidate, c.no_credit_card, c.no_deposit, c.no_loan, c.cross_sell_score, c.recommended_product,
  c.recommendation_reason, c.campaign_priority, c.contact_eligible_flag, c.suppression_reason, c.campaign_type, m.cob_dt
FROM g_mart m LEFT JOIN g_campaign c ON m.customer_id = c.customer_id AND m.cob_dt = c.cob_dt"""

V["v_all"] = " UNION ALL ".join(
    f"SELECT 'dim_{e}' AS dim, CAST({COLUMNS[e][0]} AS VARCHAR) AS business_key, {e}_sk AS sk, effective_from, effective_to, is_current FROM d_{e}"
    for e in COLUMNS
)

_NAMES = re.compile(r"\b(" + "|".join(sorted(V, key=len, reverse=True)) + r")\b")


def with_views(sql: str) -> str:
    """Put the views a query refers to, and theirs, in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name not in order:
                visit(V[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({V[name].strip()})" for name in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
