"""Schemas, masks, sources and sinks at their edges."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions import columns as C
from tellerflow.operators import sinks
from tellerflow.plans import marts
from tellerflow.sources import files, jdbc


def test_declared_shapes(lake):
    assert len(S.MART_360.columns) == 33 and len(S.DASHBOARD_360.columns) == 46
    assert not set(S.PII_COLUMNS) & set(S.DASHBOARD_360.columns)
    for name, feed in S.FEEDS.items():
        S.assert_schema(lake.feed(name), feed)


def test_schema_refusal(spark):
    wrong = spark.range(1).select(F.lit("x").alias("branch_code"), F.lit(1).alias("extra"))
    with pytest.raises(ValueError, match=r"missing=\['address'.*unexpected=\['extra'\]"):
        S.assert_schema(wrong, S.FEEDS["branch"])


@pytest.mark.parametrize("name, full, short", [
    ("Ho Thi My Lan", "Ho T** L**", "Ho **"), ("Ho Lan", "Ho L**", "Ho **"), ("Ho", "H**", "Ho **"), (None, None, None)])
def test_name_masks(spark, name, full, short):
    df = spark.createDataFrame([(name,)], "n STRING")
    row = df.select(C.mask_name_full(F.col("n")).alias("f"), C.mask_name_short(F.col("n")).alias("s")).first()
    assert (row.f, row.s) == (full, short)


def test_contact_masks(spark):
    df = spark.createDataFrame([("0912345678", "anna@mail.com"), ("091", "a@b.c"), (None, None), ("1", "nolocal")], "p STRING, e STRING")
    got = [(r.p, r.e) for r in df.select(C.mask_phone(F.col("p")).alias("p"), C.mask_email(F.col("e")).alias("e")).collect()]
    assert got == [("091****678", "a*****a@mail.com"), ("091****", "a*****a@b.c"), (None, None), ("1****", None)]
    with pytest.raises(ValueError, match="salt"):
        C.hash_national_id(F.lit("1"), "")


def test_segment_ladder(spark):
    cases = {(0, 5, 5, 5): "Lost", (1, 2, 3, 1): "At Risk", (1, 5, 4, 4): "Champions", (1, 3, 4, 3): "Loyal Customers", (1, 5, 2, 1): "New Customers",
             (1, 3, 3, 2): "Potential Loyalists", (1, 1, 1, 1): "Lost", (1, 2, 2, 2): "Hibernating", (1, 3, 2, 2): "Hibernating"}
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "a INT, r INT, f INT, m INT, want STRING")
    got = df.select("want", C.rfm_segment(F.col("a") == 1, F.col("r"), F.col("f"), F.col("m")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_bound_parameters(spark, lake):
    with pytest.raises(AnalysisException):
        files.run_sql(spark, "SELECT :cob_dt, :other", {}, cob_dt=lake.day).collect()


def test_jdbc_options():
    # a database would have to be started to run the scans; Spark gets exactly these options
    source = jdbc.JdbcSource("jdbc:postgresql://host/db", "u", "p", fetchsize=500)
    plain = jdbc.scan_options(source, "SELECT 1 ;")
    assert plain["dbtable"] == "(SELECT 1 ) t" and plain["driver"] == "org.postgresql.Driver" and plain["fetchsize"] == "500"
    split = jdbc.scan_options(source, "SELECT 1", fetchsize=9, split=jdbc.Partitioning("id", 1, 100, 4))
    assert (split["fetchsize"], split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("9", "id", "1", "100", "4")
    with pytest.raises(ValueError):
        jdbc.scan_options(source, "SELECT 1", split=jdbc.Partitioning("id", 5, 5, 4))
    with pytest.raises(ValueError, match="driver"):
        jdbc.JdbcSource("jdbc:unknown:x", "u", "p").options()


def test_empty_day_empties_its_partition(spark, tmp_path):
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 2)
    rows = spark.range(6).withColumn("cob_dt", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 2).cast("int")))
    sinks.overwrite_partitions(rows, path)
    assert sinks.overwrite_day(rows.limit(0), path, day) == 0
    assert [str(r.cob_dt) for r in spark.read.parquet(path).select("cob_dt").distinct().collect()] == ["2024-01-01"]
    assert sinks.overwrite_day(rows, path, day) == 3


def test_compaction_goes_on_and_names_failures(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(60).withColumn("d", F.col("id") % 2).repartition(6).write.partitionBy("d").parquet(good)
    before = sinks.fingerprint(spark.read.parquet(good)).first()
    with pytest.raises(RuntimeError, match="missing"):
        sinks.compact_tables(spark, {"missing": (str(tmp_path / "none"), "d"), "good": (good, "d")})
    assert {r.files for r in sinks.file_report(spark, good, "d").collect()} == {1}
    assert sinks.fingerprint(spark.read.parquet(good)).first() == before


def test_csv_without_header(spark, tmp_path):
    sinks.export_csv(spark.range(2).coalesce(1), str(tmp_path / "c"), header=False)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "c")).collect()) == ["0", "1"]


def test_branch_summary_with_bootstrap_keeps_early_events(lake):
    strict = marts.branch_monthly_summary(lake.silver(), lake.day).agg(F.sum("txn_count")).first()[0]
    wide = marts.branch_monthly_summary(lake.silver(), lake.day, bootstrap=True).agg(F.sum("txn_count")).first()[0]
    orphans = lake.fact("txn_account").where("account_sk IS NULL").count()
    assert wide == lake.fact("txn_account").count() - orphans > strict
