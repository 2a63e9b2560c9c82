"""Nothing is lost silently: columns, keys, stopped writes, tiles of any type, compaction, repeated runs."""

import datetime as dt
import os

import pytest
from conftest import DATA
from pyspark.sql import Window
from pyspark.sql import functions as F

from tellerflow.lake import SALT, SCD1, Lake
from tellerflow.operators import asof, buckets, history, ranking, sinks
from tellerflow.plans import quality
from tellerflow.plans.pipeline import Pipeline
from tellerflow.session import shared_dir
from tellerflow.sources import bank

DAY = dt.date(2024, 1, 30)
SPEC = history.Dimension("dim", ("k",), ("a",), "dim_sk")


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")


def test_a_history_refuses_other_columns(snapshot):
    stored = history.open_versions(snapshot, SPEC, DAY - dt.timedelta(days=1))
    for bad in (snapshot.withColumn("b", F.lit(1)), snapshot.select("k", "a", F.col("a").alias("A2")), snapshot.select("k")):
        with pytest.raises(ValueError, match="columns differ"):
            history.apply_snapshot(stored, bad, SPEC, DAY)
    assert history.apply_snapshot(stored, snapshot, SPEC, DAY).count() == 2


def test_a_current_state_table_refuses_other_columns_and_bad_keys(spark, snapshot):
    for bad in (snapshot.withColumn("b", F.lit(1)), snapshot.select("k")):
        with pytest.raises(ValueError, match="columns differ"):
            history.scd1_upsert(snapshot, bad, ["k"])
    twice = spark.createDataFrame([(1, "x"), (1, "z"), (None, "n")], "k long, a string")
    with pytest.raises(ValueError, match="duplicate business key, null business key"):
        history.scd1_upsert(snapshot, twice, ["k"])
    assert sorted(map(tuple, history.scd1_upsert(snapshot, twice.limit(1).withColumn("k", F.lit(2).cast("long")), ["k"]).collect())) == [(1, "x"), (2, "x")]


def test_a_replace_stopped_between_renames_loses_nothing(spark, snapshot, tmp_path):
    path = str(tmp_path / "table")
    sinks.overwrite_all(snapshot, path)
    os.rename(path, f"{path}__old_12345678")  # where a run has been stopped
    sinks.restore(spark, path)
    assert spark.read.parquet(path).count() == 2
    os.rename(path, f"{path}__old_12345678")
    sinks.overwrite_all(snapshot.limit(1), path)
    assert spark.read.parquet(path).count() == 1 and [p.name for p in tmp_path.iterdir()] == ["table"]


def test_daily_slice_prunes_old_partitions(spark, snapshot, tmp_path):
    path = str(tmp_path / "dim")
    buckets.save_history(history.open_versions(snapshot, SPEC, DAY - dt.timedelta(days=9)), path, SPEC.keys)
    stored = buckets.read(spark, path)
    after = history.apply_snapshot(history.day_slice(stored, DAY), snapshot.limit(1), SPEC, DAY)
    scans = [line for line in after._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all("effective_to" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans)


@pytest.mark.parametrize("kind", ["double", "date", "string", "decimal(20,9)", "timestamp"])
def test_tiles_of_any_type_and_nulls(spark, kind):
    v = {"double": F.col("id") * 1e-8, "date": F.date_add(F.lit(DAY), F.col("id").cast("int")), "string": F.concat(F.lit("v"), F.col("id")),
         "decimal(20,9)": (F.col("id") / 1_000_000_000), "timestamp": F.timestamp_seconds("id")}[kind].cast(kind)
    rows = spark.range(43).select("id", F.when(F.col("id") % 9 != 4, v).alias("v")).repartition(5)
    got = ranking.ntile(rows, "id", {"t": F.col("v")}, 10)
    want = rows.withColumn("t", F.ntile(10).over(Window.orderBy("v", "id")))
    assert sorted((r.id, r.t) for r in got.collect()) == sorted((r.id, r.t) for r in want.collect())


def test_compaction_keeps_to_its_target_and_to_names(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60_000).select(F.concat(F.lit("00"), F.col("id") % 2).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.repartition(12).write.partitionBy("p").parquet(path)
    before = sinks.fingerprint(rows.select("v", "p")).first()
    target = 60_000
    done = {r.p: r.pieces for r in sinks.compact(spark, path, "p", target_bytes=target).collect()}
    assert set(done) == {"000", "001"} and min(done.values()) >= 30
    assert sorted(f for f in os.listdir(path) if f.startswith("p=")) == ["p=000", "p=001"]
    sizes = [os.path.getsize(f"{path}/p={p}/{f}") for p in done for f in os.listdir(f"{path}/p={p}") if f.endswith(".parquet")]
    assert max(sizes) <= 2 * target and len(sizes) == sum(done.values())
    assert sinks.fingerprint(sinks._as_named(spark, path, "p").select("v", "p")).first() == before


def test_verify_finds_an_overlap_among_closed_versions(spark, tmp_path, monkeypatch):
    from tellerflow.plans import pipeline

    spec = history.DIMENSIONS["product"]
    monkeypatch.setattr(history, "DIMENSIONS", {"product": spec})
    job = Pipeline(spark, str(tmp_path), None, SALT)
    start = DAY - dt.timedelta(days=400)
    row = tuple(None for _ in spec.tracked)
    columns = ", ".join(["product_code STRING", *(f"{c} STRING" for c in spec.tracked), "effective_from DATE, effective_to DATE, is_current INT, product_sk STRING"])

    def version(first, last, sk):
        return ("p1", *row, start + dt.timedelta(first), last if isinstance(last, dt.date) else start + dt.timedelta(last), int(isinstance(last, dt.date)), sk)

    sound = [version(0, 9, "a"), version(10, 19, "b"), version(20, dt.date(9999, 12, 31), "c")]
    buckets.save_history(spark.createDataFrame(sound, columns), job.path("silver", "dim_product"), spec.keys)
    job.verify_dimensions()
    torn = [sound[0], version(5, 19, "b"), sound[2]]  # among versions closed more than a year ago
    broken = pipeline.Pipeline(spark, str(tmp_path / "torn"), None, SALT)
    buckets.save_history(spark.createDataFrame(torn, columns), broken.path("silver", "dim_product"), spec.keys)
    history.guard_history(history.day_slice(broken.read("silver", "dim_product"), DAY), spec)  # the day's own check does not see it
    with pytest.raises(RuntimeError, match="overlapping_ranges"):
        broken.verify_dimensions()


def test_scratch_folders_go_also_after_a_failure(spark, snapshot):
    for fail in (False, True):
        try:
            with sinks.scratch(spark, "test") as folder:
                sinks.durable(snapshot, "x")
                assert sinks.exists(spark, folder) and folder.startswith(shared_dir(spark))
                if fail:
                    raise RuntimeError("stop")
        except RuntimeError:
            pass
        assert not sinks.exists(spark, folder)


def test_check_lists_are_validated_first():
    for bad in ([], [quality.CHECKS[0]] * 2, [quality.Check("", "gold", "t", "k", None)]):
        with pytest.raises(ValueError):
            quality.run_checks(bad, {}, DAY, "r", "d")


def test_a_failed_run_repeated_under_its_id_equals_a_clean_one(spark, tmp_path):
    lake, broken = Lake(spark, DATA), True

    def feed(entity, day):
        base = lake.feed(entity)
        if entity in asof.FACTS:
            return base.where(F.col(asof.FACTS[entity].event) >= F.lit(dt.datetime(2024, 1, 25)).cast("timestamp_ntz"))
        if entity in SCD1:
            return bank.scd1_day(base, *SCD1[entity], False)
        return base.unionByName(base.limit(1)) if broken and entity == "product" else base

    repeated, clean = (Pipeline(spark, str(tmp_path / name), feed, SALT) for name in ("repeated", "clean"))
    with pytest.raises(ValueError, match="duplicate business key"):
        repeated.run(lake.base, "day", initial=True)
    broken = False
    repeated.run(lake.base, "day", initial=True, scheduler_run="manual-2")
    clean.run(lake.base, "day", initial=True)
    prints = lambda job: {n: tuple(sinks.fingerprint(df.drop("last_updated")).first()) for n, df in job.tables().items()}
    assert prints(repeated) == prints(clean)
    log = repeated.read("ops", "run_log")
    assert {(r.try_number, r.dag_run_id) for r in log.select("try_number", "dag_run_id").distinct().collect()} == {(1, "day"), (2, "manual-2")}


def test_wrong_job_specs_fail_before_spark():
    from tellerflow.plans.pipeline import GOLD, Gold

    for bad, message in ((Gold("no_such_mart"), "no mart plan"), (Gold("score"), "no declared schema"), (Gold("rfm_segment", "upsert"), "unknown write strategy")):
        with pytest.raises(ValueError, match=message):
            Pipeline(None, "nowhere", None, SALT, gold=(*GOLD, bad))


def test_every_stored_table_has_its_declared_schema(spark, lake):
    from tellerflow import schemas as S

    for name, df in lake.tables().items():
        S.assert_schema(df, S.TABLES["customer_360" if name == "mart_customer_360_history" else name])
    with pytest.raises(ValueError, match="schema differs"):
        S.assert_schema(lake.tables()["rfm_segment"].withColumn("frequency", F.col("frequency").cast("int")), S.TABLES["rfm_segment"])
