"""As-of resolution and exact tiles against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerflow.operators import asof, ranking

D0 = dt.date(2024, 1, 1)


@pytest.mark.parametrize("merge, hot", [(False, 0), (True, 1_000_000), (True, 20)])
def test_resolve_against_brute_force(spark, monkeypatch, merge, hot):
    monkeypatch.setattr(asof, "HOT_EVENTS", hot)
    rnd = random.Random(7)
    versions = []
    for key in range(6):
        start = rnd.randint(3, 8)
        for n in range(rnd.randint(1, 4)):
            length = rnd.randint(1, 5)
            versions.append((key, f"{key}.{n}", D0 + dt.timedelta(days=start), D0 + dt.timedelta(days=start + length - 1)))
            start += length + rnd.randint(0, 2)
    # one key holds a third of all events
    events = [(i, 0 if i % 3 == 0 else rnd.randint(0, 8), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 30))) for i in range(300)]
    dims = spark.createDataFrame(versions, "k BIGINT, sk STRING, effective_from DATE, effective_to DATE")
    facts = spark.createDataFrame(events, "id BIGINT, k BIGINT, at TIMESTAMP_NTZ")
    lookup = [asof.Lookup(dims, "k", "sk")]

    def brute(key, at, bootstrap):
        mine = sorted(v for v in versions if v[0] == key)
        first = min((v[2] for v in mine), default=None)
        for _, sk, start, stop in mine:
            if start <= at.date() <= stop or (bootstrap and at.date() < first and start == first):
                return sk
        return None

    for bootstrap in (False, True):
        want = {i: brute(k, at, bootstrap) for i, k, at in events}
        for how in ("left", "inner"):
            out = asof.resolve(facts, "at", lookup, bootstrap=bootstrap, how=how, merge=merge)
            assert out.columns == ["id", "k", "at", "sk"]
            got = [(r.id, r.sk) for r in out.collect()]
            assert sorted(got, key=str) == sorted(((i, sk) for i, sk in want.items() if sk or how == "left"), key=str)


def test_a_key_with_many_versions_costs_their_sum(spark, monkeypatch):
    """One key has 3,000 versions of a day and 60,000 events; events without key or date stay without a version."""
    monkeypatch.setattr(asof, "HOT_EVENTS", 10_000)
    start, n = "DATE '2015-01-01'", 3000
    versions = spark.range(n).selectExpr("1L AS k", f"CAST(date_add({start}, CAST(id AS INT)) AS STRING) AS sk", f"date_add({start}, CAST(id AS INT)) AS effective_from")
    versions = versions.withColumn("effective_to", F.col("effective_from")).where("day(effective_from) <> 13")  # a gap every month
    hours = f"CAST({start} AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, 0, CAST(id * 1.2 AS INT), 0, 0)"
    facts = spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 1000 = 1 THEN 2 ELSE 1 END AS k", f"CASE WHEN id % 50 = 7 THEN NULL ELSE {hours} END AS at")
    out = asof.resolve(facts, "at", [asof.Lookup(versions, "k", "sk")])  # many versions: chosen by itself
    assert "Window" in out._jdf.queryExecution().executedPlan().toString()
    expected = F.when((F.col("k") == 1) & (F.dayofmonth("at") != 13), F.col("at").cast("date").cast("string"))
    assert out.where(~F.col("sk").eqNullSafe(expected)).count() == 0
    assert out.count() == 60_000


def test_versions_come_through_the_column_events_are_partitioned_by(spark):
    """Repeated rows, keys and columns that are NULL, several owners of one account: the same rows as by the business key."""
    rnd = random.Random(3)
    versions = [(k, f"{k}.{n}", D0 + dt.timedelta(days=9 * n), D0 + dt.timedelta(days=9 * n + rnd.randint(3, 8))) for k in range(9) for n in range(rnd.randint(1, 3))]
    dims = spark.createDataFrame([*versions, versions[0]], "k BIGINT, sk STRING, effective_from DATE, effective_to DATE")
    owners = [(a, rnd.choice([None, *range(11)])) for a in [*range(40), *range(10)]]
    at = lambda: rnd.choice([None, *[dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 30)) for _ in range(9)]])
    events = [(i, *rnd.choice(owners), at()) for i in range(400)] + [(900 + i, None, i % 10, at()) for i in range(20)]
    facts = spark.createDataFrame(events, "id BIGINT, a BIGINT, k BIGINT, at TIMESTAMP_NTZ")
    pairs = spark.createDataFrame(owners, "a BIGINT, k BIGINT")
    found = lambda lookup, **options: sorted((str(r) for r in asof.resolve(facts, "at", [lookup], merge=False, **options).collect()))
    for options in ({}, {"bootstrap": True}, {"how": "inner"}, {"day": D0 + dt.timedelta(days=4)}):
        plain = found(asof.Lookup(dims, "k", "sk"), **options)
        assert plain and found(asof.Lookup(dims, "k", "sk", "a", pairs), **options) == plain


def test_fact_contract(spark):
    spec = asof.Fact("f", "id", "at", ("customer",))
    at = dt.datetime(2024, 1, 1, 5)
    make = lambda *rows: spark.createDataFrame(rows, "id BIGINT, at TIMESTAMP_NTZ, cob_dt DATE")
    assert asof.guard_fact(make((1, at, D0), (2, at, D0)), spec, D0) == 2
    for bad, rule in (
        (make((1, at, D0), (1, at, D0)), "duplicate_keys"), (make((1, at, None)), "null_partition"),
        (make((1, at + dt.timedelta(days=1), D0 + dt.timedelta(days=1))), "outside_day"), (make((1, at + dt.timedelta(days=1), D0)), "misdated"),
    ):
        with pytest.raises(ValueError, match=rule):
            asof.guard_fact(bad, spec, D0)
    with pytest.raises(ValueError, match="missing columns"):
        asof.guard_fact(make((1, at, D0)).drop("cob_dt"), spec, D0)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 1003])
def test_tiles_equal_ntile(spark, n):
    # a third of all rows share one value
    rows = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(50))).alias("v"), F.pmod(F.xxhash64("id"), F.lit(9)).alias("w")
    )
    tiled = ranking.ntile(rows, "id", {"a": F.col("v"), "b": -F.col("w")})
    want = rows.withColumns(
        {"a": F.ntile(5).over(Window.orderBy("v", "id")), "b": F.ntile(5).over(Window.orderBy(F.col("w").desc(), "id"))}
    )
    key = lambda df: sorted((r.id, r.a, r.b) for r in df.collect())
    assert key(tiled) == key(want)


def test_tiles_of_all_types_sort_only_their_brackets(spark, monkeypatch):
    """NULLs, NaN, ties of a third of all rows, types with and without quantiles, values beyond a double's digits."""
    rows = spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("h")).selectExpr(
        "id", "h", "CAST(IF(id % 3 = 0, 7, h) AS DECIMAL(15, 2)) AS tied", "IF(id % 4 = 0, NULL, h / 7) AS holes", "IF(id % 4 = 0, CAST('NaN' AS DOUBLE), h / 7) AS nan",
        "CAST(h AS STRING) AS text", "timestamp_micros(h * 1000003) AS at", "CAST(timestamp_micros(h * 1000003) AS TIMESTAMP_NTZ) AS at_ntz", "date_add(DATE '2024-01-01', CAST(h % 900 AS INT)) AS day",
        "CAST(NULL AS INT) AS none", "CAST(9000000000000000000 + h AS DECIMAL(38, 0)) AS wide", "9000000000000000000 + h AS long", "CAST(h % 5 AS FLOAT) AS few",
    ).cache()
    seen = []
    in_order = ranking.in_order
    monkeypatch.setattr(ranking, "in_order", lambda frame, keys: seen.append(frame.groupBy("order").count().collect()) or in_order(frame, keys))
    names = [c for c in rows.columns if c != "id"]
    tiled = ranking.ntile(rows, "id", {f"t_{c}": F.col(c) for c in names})
    want = rows.withColumns({f"w_{c}": F.ntile(5).over(Window.orderBy(c, "id")) for c in names}).select("id", *[f"w_{c}" for c in names])
    wrong = tiled.join(want, "id").agg(*[F.count_if(F.col(f"t_{c}") != F.col(f"w_{c}")).alias(c) for c in names]).first().asDict()
    assert not any(wrong.values()), wrong
    (counts,) = seen
    held = {names[r["order"]]: r["count"] for r in counts}
    assert all(held[c] < 500 for c in ("h", "at", "at_ntz")), held  # four brackets of a few thousandths
    assert held["nan"] == held["text"] == held["wide"] == 20_000 and held["tied"] < 8_000
    rows.unpersist()


def test_tile_starts_cover_small_and_uneven_counts():
    for n in range(51):
        starts = [s for s in ranking.tile_starts(n, 5) if s is not None]
        tiles = [1 + sum(s <= rank for s in starts) for rank in range(n)]
        sizes = [tiles.count(t) for t in range(1, 6)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_dense_ids(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("k"))
    got = sorted((r.k, r.n) for r in ranking.dense_ids(rows, ["k"], "n").collect())
    assert got == [(k, k + 1) for k in range(500)]
