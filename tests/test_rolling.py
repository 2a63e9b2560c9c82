"""Activity carried from day to day against plain sums over all events."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tellerflow.operators import activity, rolling
from tellerflow.operators.sinks import durable

D0 = dt.date(2023, 1, 1)
SCHEMA = "customer_id BIGINT, channel STRING, merchant_category STRING, txn_date TIMESTAMP_NTZ, txn_amount DECIMAL(18,2), debit_credit STRING, status STRING, txn_type STRING, cob_dt DATE"


def event(rnd: random.Random, day: dt.date) -> tuple:
    at = dt.datetime.combine(day, dt.time(rnd.randint(0, 23), rnd.randint(0, 59)))
    amount = rnd.choice([None, decimal.Decimal(rnd.randint(-90_000, 90_000)) / 100])
    customer = rnd.choice([1, 1, 1, rnd.randint(2, 9), None])  # one customer holds more than half of all events
    status, kind = rnd.choice(["SUCCESS", "SUCCESS", "FAILED"]), rnd.choice(["PURCHASE", "PURCHASE", "REFUND"])
    return (customer, rnd.choice(["A", "B", None]), rnd.choice(["x", "y", None]), at, amount, rnd.choice(["C", "D", None]), status, kind, day)


def plain_account(events, day) -> set:
    out = set()
    for customer in {e[0] for e in events}:
        inside = lambda w: [e for e in events if e[0] == customer and day - dt.timedelta(w) <= e[8] <= day]  # noqa: E731, B023
        if not inside(365):
            continue
        add = lambda values: sum(values) if values else None
        sizes = {w: add([abs(e[4]) for e in inside(w) if e[4] is not None]) for w in (30, 90, 365)}
        month = inside(30)
        side = lambda k: [e for e in month if e[5] == k]  # noqa: E731, B023
        used = {c: sum(e[1] == c for e in month) for c in {e[1] for e in month}}
        channel = min(used, key=lambda c: (-used[c], c is not None, c or "")) if used else None
        row = [customer]
        for w in (30, 90, 365):
            row += [len(inside(w)), sizes[w], max((e[3] for e in inside(w)), default=None)]
        row += [len(side("C")), len(side("D")), add([e[4] for e in side("C") if e[4] is not None]), add([abs(e[4]) for e in side("D") if e[4] is not None]), channel]
        out.add(tuple(row))
    return out


ACCOUNT = ["customer_id", *[f"{m}_{w}" for w in (30, 90, 365) for m in ("cnt", "amt", "last")], "credit_cnt", "debit_cnt", "credit_amt", "debit_amt", "primary_channel"]


def rows_of(df, columns) -> set:
    return {tuple(r) for r in df.select(*columns).collect()}


def test_account_activity_over_random_days_and_late_corrections(spark):
    """Steps of one to 60 days; days are loaded again with events added, changed and removed."""
    rnd = random.Random(5)
    days = [D0 + dt.timedelta(n) for n in range(560)]
    events = [event(rnd, rnd.choice(days)) for _ in range(700)]
    src = activity.SOURCES["account"]
    spec = src.spec()
    parts = durable(src.partials(spark.createDataFrame(events, SCHEMA)), "parts")
    day = D0 + dt.timedelta(370)
    state = durable(rolling.state_of(parts, spec, day), "state")
    for step in range(20):
        assert rows_of(src.activity(state), ACCOUNT) == plain_account(events, day)
        if step % 4 == 3:
            last = [e[8] for e in events if e[8] <= day]
            late = [max(last), rnd.choice(days[:400]), day - dt.timedelta(31)]
            old = parts.where(F.col("cob_dt").isin(late))
            events = [e for e in events if e[8] not in late or rnd.random() < 0.4] + [event(rnd, d) for d in late[1:] for _ in range(2)]
            kept = spark.createDataFrame([e for e in events if e[8] in late] or events[:0], SCHEMA)
            new = durable(src.partials(kept), "new")
            after = durable(parts.where(~F.col("cob_dt").isin(late)).unionByName(new), "parts")
            state = durable(rolling.correct(state, old, new, after, spec, late, day), "state")
            parts = after
            assert rows_of(src.activity(state), ACCOUNT) == plain_account(events, day)
        before, day = day, day + dt.timedelta(rnd.choice([1, 1, 1, 2, 7, 30, 60]))
        state = durable(rolling.advance(state, parts, spec, before, day), "state")


@pytest.mark.parametrize("source, whole", [("account", activity.account_activity), ("card", activity.card_activity)])
def test_states_equal_the_scan_of_the_fact(spark, source, whole):
    rnd = random.Random(6)
    fact = spark.createDataFrame([event(rnd, D0 + dt.timedelta(rnd.randint(0, 430))) for _ in range(500)], SCHEMA)
    src = activity.SOURCES[source]
    spec, day = src.spec(), D0 + dt.timedelta(400)
    parts = durable(src.partials(fact), "parts")
    state = rolling.advance(durable(rolling.state_of(parts, spec, day - dt.timedelta(1)), "state"), parts, spec, day - dt.timedelta(1), day)
    want = whole(fact, day)
    assert rows_of(src.activity(state), want.columns) == rows_of(want, want.columns)


def test_a_step_reads_the_new_day_and_one_day_for_each_window(spark, tmp_path):
    src = activity.SOURCES["account"]
    rows = [event(random.Random(n), D0 + dt.timedelta(n)) for n in range(420)]
    src.partials(spark.createDataFrame(rows, SCHEMA)).coalesce(1).write.partitionBy("cob_dt").parquet(str(tmp_path / "parts"))
    day = D0 + dt.timedelta(400)
    moved = spark.read.parquet(str(tmp_path / "parts")).where(rolling.moving_days(src.spec(), day - dt.timedelta(1), day))
    assert {r.cob_dt for r in moved.select("cob_dt").distinct().collect()} == {day, *[day - dt.timedelta(w + 1) for w in (30, 90, 365)]}
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan  # whole files are left out
    with pytest.raises(ValueError, match="cannot move on"):
        rolling.advance(moved, moved, src.spec(), day, day)
