"""Stored tables without surrogate keys give the same rows as the plans they come from."""

import datetime as dt

import pytest

from tellerflow.lake import Lake
from tellerflow.operators import asof, history

NOON = dt.datetime(2001, 5, 4, 12)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Keys that are NULL or repeated, events without a key, date or known order."""
    folder = str(tmp_path_factory.mktemp("given"))

    def save(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")

    people = [(k, f"Customer#{k}", k % 3, 400.0 * k, "AUTOMOBILE") for k in range(1, 25)] + [(None, None, None, None, None), (11, "Customer#11", 1, 5.0, None)]
    save("customer", people, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING")
    orders = [(k, k % 24 + 1, "OFP"[k % 3], 100.0 + k, NOON, "1-URGENT" if k % 2 else "5-LOW") for k in range(1, 70)]
    orders += [(31, 5, "O", 1.0, NOON, "5-LOW"), (None, 3, "O", 1.0, NOON, None), (70, None, None, None, None, None), (71, 900, "F", 7.0, NOON, "5-LOW")]
    save("orders", orders, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
    last = dt.datetime(2001, 11, 4)  # moved onto the second processing day
    lines = [(k % 74, k, k % 7, k % 4, float(k), 10.0 * k, 0.0, 0.0, "R" if k % 5 else "N", "F", last if k % 3 else NOON) for k in range(300)]
    lines += [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, None, None, NOON), (9, None, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "O", NOON), (9, 4, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "O", None)]
    save("lineitem", lines, "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
         "l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")
    return Lake(spark, folder)


@pytest.mark.parametrize("entity", ["customer", "account"])
def test_a_stored_dimension_gives_its_keys_again(odd, entity):
    plan, stored, sk = odd.versions(entity), odd.dim(entity), history.DIMENSIONS[entity].sk
    assert stored.columns == plan.columns and rows(stored) == rows(plan)
    assert sk not in odd.spark.read.parquet(f"{odd.root}/dim_{entity}").columns


def test_a_stored_fact_gives_its_keys_again(odd):
    spec, day = asof.FACTS["txn_account"], odd.day
    events = odd.bronze("txn_account").drop("last_updated")
    lookups = [asof.Lookup(odd.versions(d), f"{d}_id", f"{d}_sk") for d in spec.dimensions]
    first = asof.resolve(events.where(events.cob_dt < day), spec.event, lookups, bootstrap=True)
    whole = first.unionByName(asof.resolve(events.where(events.cob_dt == day), spec.event, lookups, day=day))
    stored = odd.fact("txn_account")
    assert stored.columns == whole.columns and stored.schema["customer_sk"].dataType.simpleString() == "string"
    found = whole.collect()
    assert any(r.account_sk is None for r in found) and any(r.account_sk and r.cob_dt == day for r in found)
    assert rows(stored) == sorted(map(str, found)) == rows(odd.fact_initial("txn_account").unionByName(odd.fact_daily("txn_account")))
    files = odd.spark.read.parquet(f"{odd.root}/{spec.name}")
    assert [files.schema[f"{d}_sk"].dataType.simpleString() for d in spec.dimensions] == ["date", "date"]


def test_digits_and_events_are_not_shuffled_for_keys(odd):
    """The history join carries no surrogate key, and account events are not shuffled once more for their customers."""
    spark = odd.spark
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        joined = plan(odd.versions("account").drop("account_sk"))
        assert "SortMergeJoin" in joined and "sha2" not in joined[joined.index("SortMergeJoin"):]
        lines = plan(odd._initial("txn_account")).split("\n")
        at = next(i for i, line in enumerate(lines) if "SortMergeJoin [account_id" in line and "[_by#" in line)
        below = next(i for i in range(at + 1, len(lines)) if "Join" in lines[i])  # the accounts' join, on the events' side
        assert "[account_id" in lines[below] and not any("Exchange" in line or "Sort " in line for line in lines[at + 1 : below])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_check_and_a_mart_build_only_the_tables_they_read(odd):
    from tellerflow.plans import quality

    lake = Lake(odd.spark, "/root/testdata/sf0.001")
    check = next(c for c in quality.CHECKS if c.name == "scd2_no_effective_range_overlap")
    assert check.run(lake.tables(), lake.day).first().failed_count == 0
    assert set(lake._stored) == {f"dim_{e}" for e in history.DIMENSIONS}
    lake.mart_plan("product_summary", lake.day).count()
    assert set(lake._stored) == {*(f"dim_{e}" for e in history.DIMENSIONS), "dim_deposit", "dim_loan", "dim_card"}


def test_a_stored_mart_holds_starts_and_gives_its_keys_again(lake):
    spec = history.DIMENSIONS["customer"]
    keys = {(r.customer_id, r.customer_sk) for r in lake.versions("customer").select("customer_id", spec.sk).collect()}
    for name in ("rfm_segment", "campaign_target"):
        found = lake.gold(name).select("customer_id", "customer_sk").collect()
        assert found and {(r.customer_id, r.customer_sk) for r in found} <= keys
        files = lake.spark.read.parquet(f"{lake.root}/{name}").select("customer_sk").distinct().collect()
        assert {r.customer_sk for r in files} <= {str(lake.base), str(lake.day)}
    assert lake.mart().columns == lake.mart_plan("customer_360", lake.day).columns


def test_a_packed_table_is_broadcast_by_its_measured_size_only(spark, tmp_path):
    """400,000 cards are estimated at under 10 MB from their files, and are not held by the driver for that."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    kept = {name: spark.conf.get(name, None) for name in (planned, measured)}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.range(400_000).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey", "CAST(id % 9000 AS DOUBLE) AS c_acctbal",
                                    "'AUTOMOBILE' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    try:
        spark.conf.set(planned, "10485760b")
        spark.conf.unset(measured)
        lake = Lake(spark, str(tmp_path))
        upsert = lambda new: history.scd1_upsert(lake.snapshot("card", lake.base), new, ["card_id"])
        assert "Broadcast" not in plan(upsert(lake.snapshot("card", lake.day)))
        few = upsert(lake.snapshot("card", lake.day).where("card_id < 10"))
        assert few.count() > 0
        found = few.select("card_id")
        found.collect()
        assert "BroadcastHashJoin" in plan(found)  # as measured
        spark.conf.set(planned, "100000")
        Lake(spark, str(tmp_path))
        assert spark.conf.get(planned) == "100000"  # a caller's lower one stays
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_marts_add_up_holdings_once(lake, monkeypatch):
    """Deposits have no history, so one aggregate serves all marts of both days; accounts have one for each day."""
    from tellerflow.lake import LazySilver
    from tellerflow.operators import activity
    from tellerflow.plans import marts

    calls = []
    for name in ("account_holdings", "deposit_holdings"):
        usual = getattr(activity, name)
        monkeypatch.setattr(activity, name, lambda rows, name=name, usual=usual: calls.append(name) or usual(rows))
    silver = LazySilver(lake.silver()._frames, states=None, months=None)
    found = {(f.__name__, day): f(silver, day) for f in (marts.balance_summary, marts.product_summary) for day in (lake.base, lake.day)}
    assert sorted(calls) == ["account_holdings"] * 2 + ["deposit_holdings"]
    for day in (lake.base, lake.day):
        accounts = lake.dim("account").where(f"DATE '{day}' BETWEEN effective_from AND effective_to")
        customers = lake.dim("customer").where(f"DATE '{day}' BETWEEN effective_from AND effective_to").select("customer_id")
        want = accounts.join(customers, "customer_id").count()
        assert want > 0 and found["product_summary", day].selectExpr("sum(total_accounts)").first()[0] == want
