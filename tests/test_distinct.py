"""Bitmaps and branch months that grow by a day, against plain sets."""

import datetime as dt
import decimal
import random

from pyspark.sql import functions as F

from tellerflow.operators import distinct
from tellerflow.operators.sinks import durable
from tellerflow.plans import branch_months as B

D0 = dt.date(2024, 1, 28)


def test_counts_of_any_ids_and_merges(spark):
    rnd = random.Random(3)
    ids = [None, 0, -1, -32768, 32768, 32769, 2**40, -(2**40), *range(1, 60)]
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 3), rnd.choice(ids), rnd.choice(ids)) for _ in range(600)]
    df = spark.createDataFrame(rows, "g STRING, part INT, x BIGINT, y BIGINT")
    want = {g: tuple(len({r[i] for r in rows if r[0] == g} - {None}) for i in (2, 3)) for g in ("a", "b", None)}
    both = distinct.count_distinct(df, ["g"], {"nx": F.col("x"), "ny": F.col("y")})
    assert {r.g: (r.nx, r.ny) for r in both.collect()} == want
    parts = durable(distinct.bitmaps(df, ["g", "part"], "x"), "maps")  # four parts, merged without the rows
    again = distinct.merged(parts.unionByName(parts.where("part = 1")), ["g"])
    assert {r.g: r.n for r in distinct.counts(again, ["g"], "n").collect()} == {g: n[0] for g, n in want.items()}
    assert distinct.count_distinct(df.limit(0), ["g"], {"n": F.col("x")}).count() == 0
    unseen = distinct.count_distinct(df.where("x IS NULL").where("g = 'a'"), ["g"], {"n": F.col("x")}).collect()
    assert [r.n for r in unseen] in ([], [0])


def test_numbers_stay_and_new_keys_follow(spark):
    make = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k STRING")
    first = durable(distinct.extend(None, make("m", "c", None, "c"), "k"), "numbers")
    assert {r.k: r.number for r in first.collect()} == {"c": 1, "m": 2}
    second = distinct.extend(first, make("a", "m", "z", None), "k")
    assert {r.k: r.number for r in second.collect()} == {"c": 1, "m": 2, "a": 3, "z": 4}


def test_months_grow_by_days_and_equal_the_rebuild(spark):
    rnd = random.Random(8)
    versions = []
    for account in range(12):
        cut = D0 + dt.timedelta(rnd.randint(1, 40))
        versions.append((account, rnd.choice(["B1", "B2"]), dt.date(2000, 1, 1) if account % 3 else D0 + dt.timedelta(5), cut - dt.timedelta(1)))
        versions.append((account, rnd.choice(["B1", "B3", None]), cut, dt.date(9999, 12, 31)))
    accounts = spark.createDataFrame(versions, "account_id BIGINT, branch_code STRING, effective_from DATE, effective_to DATE")

    def event(day):
        amount = rnd.choice([None, decimal.Decimal(rnd.randint(-5000, 5000)) / 100])
        return (rnd.randint(0, 13), rnd.choice([None, *range(1, 9), 40_000]), rnd.choice(["A", "B", None]), dt.datetime.combine(day, dt.time(9)), amount, rnd.choice("CD"), day)

    days = [D0 + dt.timedelta(n) for n in range(8)]  # over the end of a month
    events = [event(rnd.choice(days)) for _ in range(300)]
    fact = spark.createDataFrame(events, "account_id BIGINT, customer_id BIGINT, channel STRING, txn_date TIMESTAMP_NTZ, txn_amount DECIMAL(18,2), debit_credit STRING, cob_dt DATE")

    def plain(until):
        groups: dict = {}
        for account, customer, channel, at, amount, kind, day in events:
            for branch in [v[1] for v in versions if v[0] == account and v[2] <= day <= v[3]]:
                if day <= until:
                    groups.setdefault((branch, day.year, day.month), []).append((customer, channel, amount, kind))
        out = set()
        for key, rows in groups.items():
            add = lambda values: sum(values) if values else None
            used = {c: sum(r[1] == c for r in rows) for c in {r[1] for r in rows}}
            amounts = [r[2] for r in rows if r[2] is not None]
            side = lambda k: add([r[2] for r in rows if r[2] is not None and r[3] == k])  # noqa: E731, B023
            top = min(used, key=lambda c: (-used[c], c is not None, c or ""))
            out.add((*key, len({r[0] for r in rows} - {None}), len(rows), add([abs(a) for a in amounts]), side("C"), side("D"), top))
        return out

    rows = lambda state: {tuple(r) for r in B.month_rows(state).select(*B.MONTH, "active_customers", *B.SUMS, "top_channel").collect()}
    whole = B.state_of(B.attributed(fact.where(F.col("cob_dt") <= F.lit(days[1])), accounts))
    state = durable(whole, "state")
    assert rows(state) == plain(days[1])
    for day in days[2:]:
        state = durable(B.merge(state, B.state_of(B.attributed(fact, accounts, day=day))), "state")
        assert rows(state) == plain(day)
    assert {f.name: f.dataType.simpleString() for f in state.schema} == {f.name: f.dataType.simpleString() for f in B.STATE.struct if f.name != "cob_dt"}


def test_a_month_without_events_left_does_not_come_back(spark):
    stored = spark.createDataFrame([("B1", 2024, 1, 5, D0), ("B1", 2024, 2, 7, D0), (None, 2024, 1, 0, D0 + dt.timedelta(3))], "branch_code STRING, txn_year INT, txn_month INT, n BIGINT, cob_dt DATE")
    assert {tuple(r) for r in B.latest(stored, D0 + dt.timedelta(3)).select("txn_month", "n").collect()} == {(2, 7)}
    assert {tuple(r) for r in B.latest(stored, D0).select("txn_month", "n").collect()} == {(1, 5), (2, 7)}
    assert B.month_rows(B.emptied(spark, [(2024, 1)])).select("n", "active_customers").collect()[0] == (0, 0)
