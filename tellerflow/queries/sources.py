"""Sources (SRC) and write strategies (SNK); sinks write below the lake's own folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.lake import Lake
from tellerflow.operators import sinks
from tellerflow.plans import business, serving
from tellerflow.queries.business import BQ3
from tellerflow.queries.oracle import D, P
from tellerflow.queries.registry import query
from tellerflow.sources import files

col, lit = F.col, F.lit


def _path(lake: Lake, name: str) -> str:
    return f"{lake.root}/{name}-{uuid.uuid4().hex[:8]}"


@query("sql_template_source", f"""
SELECT customer_id, count(*) AS txn_count, sum(txn_amount) AS txn_amount FROM e_card_txn
WHERE CAST(txn_date AS DATE) BETWEEN DATE '{D}' - 30 AND DATE '{D}' AND status = 'SUCCESS' GROUP BY customer_id""")
def sql_template_source(lake: Lake) -> DataFrame:
    text = """
        SELECT customer_id, count(*) AS txn_count, sum(txn_amount) AS txn_amount FROM {card_txn}
        WHERE CAST(txn_date AS DATE) BETWEEN date_sub(:cob_dt, 30) AND :cob_dt AND status = :wanted GROUP BY customer_id"""
    return files.run_sql(lake.spark, text, {"card_txn": lake.feed("card_txn")}, cob_dt=lake.day, wanted="SUCCESS")


@query("ingest_full_snapshot", f"SELECT *, DATE '{D}' AS cob_dt FROM e_customer_next")
def ingest_full_snapshot(lake: Lake) -> DataFrame:
    return files.full_snapshot(lake.snapshot("customer", lake.day), lake.day)


@query("ingest_incremental_day", f"SELECT *, txn_date AS created_ts, txn_date AS last_updated, DATE '{D}' AS cob_dt FROM e_card_txn WHERE CAST(txn_date AS DATE) = DATE '{D}'")
def ingest_incremental_day(lake: Lake) -> DataFrame:
    return files.incremental_day(lake.feed("card_txn"), "txn_date", lake.day)


@query("ingest_initial_history", "SELECT *, txn_date AS created_ts, txn_date AS last_updated, CAST(txn_date AS DATE) AS cob_dt FROM e_txn")
def ingest_initial_history(lake: Lake) -> DataFrame:
    return files.initial_history(lake.feed("txn_account"), "txn_date")


@query("snapshot_partition_scan", f"SELECT * FROM gg_mart WHERE cob_dt = DATE '{P}'")
def snapshot_partition_scan(lake: Lake) -> DataFrame:
    return files.snapshot_partition(lake.gold("customer_360"), lake.base).select(*S.MART_360.columns)


@query("asof_dimension_scan", f"SELECT * FROM d_customer WHERE DATE '{P}' BETWEEN effective_from AND effective_to")
def asof_dimension_scan(lake: Lake) -> DataFrame:
    return files.asof_dimension(lake.dim("customer"), lake.base)


# --- write strategies ------------------------------------------------------------------------------


def _month(lake: Lake) -> DataFrame:
    """Card facts of all days: enough partitions to show what a write replaces."""
    return lake.fact("card_txn").select("txn_id", "customer_id", "txn_amount", "status", "cob_dt")


_SLIM = "txn_id, customer_id, txn_amount, status, cob_dt"


@query("write_overwrite_partitions", f"SELECT txn_id, customer_id, CAST(txn_amount + CASE WHEN cob_dt = DATE '{D}' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS txn_amount, status, cob_dt FROM f_card")
def write_overwrite_partitions(lake: Lake) -> DataFrame:
    path, rows = _path(lake, "overwrite-partitions"), _month(lake)
    sinks.load_partitions(sinks.by_day(rows, "customer_id"), path)
    rerun = rows.where(col("cob_dt") == lit(lake.day)).withColumn("txn_amount", (col("txn_amount") + 1).cast("decimal(18,2)"))
    sinks.overwrite_partitions(rerun, path)  # only the last day is replaced
    return lake.spark.read.schema(rows.schema).parquet(path)


@query("write_overwrite_predicate", f"SELECT {_SLIM} FROM f_card WHERE cob_dt <> DATE '{D}' AND (cob_dt <> DATE '{P}' OR status = 'FAILED')")
def write_overwrite_predicate(lake: Lake) -> DataFrame:
    path, rows = _path(lake, "overwrite-day"), _month(lake)
    sinks.load_partitions(sinks.by_day(rows, "customer_id"), path)
    sinks.overwrite_day(rows.where(col("status") == "FAILED"), path, lake.base)
    sinks.overwrite_day(rows.where(col("status") == "NO SUCH STATUS"), path, lake.day)  # an empty day empties its partition
    return lake.spark.read.schema(rows.schema).parquet(path)


@query("write_overwrite_all", "SELECT * FROM g_mart WHERE has_credit_card = 1")
def write_overwrite_all(lake: Lake) -> DataFrame:
    path = _path(lake, "overwrite-all")
    sinks.overwrite_all(lake.mart(), path)
    own = lake.spark.read.parquet(path)
    sinks.overwrite_all(own.where(col("has_credit_card") == 1), path)  # the table is its own input
    return lake.spark.read.parquet(path)


@query("write_append", f"SELECT * FROM d_account WHERE is_current = 1 OR effective_from = DATE '{P}'")
def write_append(lake: Lake) -> DataFrame:
    """Old versions first, then only the versions the second day opened."""
    path = _path(lake, "append")
    versions = lake.dim("account")
    sinks.append(versions.where(col("effective_from") < lit(lake.day)), path)
    sinks.append(versions.where(col("effective_from") == lit(lake.day)), path)
    return lake.spark.read.parquet(path)


@query("create_or_replace_as_select", "SELECT * FROM g_mart")
def create_or_replace_as_select(lake: Lake) -> DataFrame:
    path = _path(lake, "replace-as-select")
    sinks.overwrite_all(serving.current_mart(lake.gold("customer_360"), lake.base), path)
    sinks.overwrite_all(serving.mart_masked(lake.mart()), path)
    return lake.spark.read.parquet(path)


@query("export_query_csv", BQ3)
def export_query_csv(lake: Lake) -> DataFrame:
    path = _path(lake, "export")
    report = business.rfm_segment_distribution(lake.masked())
    sinks.export_csv(report, path, header=True)
    return lake.spark.read.schema(report.schema).option("header", "true").csv(path)


@query("write_schema_enforced", "SELECT * FROM g_mart")
def write_schema_enforced(lake: Lake) -> DataFrame:
    path = _path(lake, "checked")
    shuffled = lake.mart().select(*sorted(lake.mart().columns))  # order does not matter, names and types do
    sinks.write_checked(shuffled, S.MART_360, path, sinks.overwrite_all)
    return lake.spark.read.parquet(path)


@query("additive_schema_evolution", f"""
SELECT customer_id, cob_dt, cross_sell_score, CASE WHEN cob_dt = DATE '{D}' THEN recommendation_reason END AS recommendation_reason FROM gg_campaign""")
def additive_schema_evolution(lake: Lake) -> DataFrame:
    """Files of the first day were written before the reason column existed."""
    path = _path(lake, "evolved")
    rows = lake.gold("campaign_target").select("customer_id", "cob_dt", "cross_sell_score", "recommendation_reason")
    sinks.append(rows.where(col("cob_dt") == lit(lake.base)).drop("recommendation_reason"), path)
    sinks.append(rows.where(col("cob_dt") == lit(lake.day)), path)
    return files.read_table(lake.spark, path, rows.schema)


@query("compact_partitions", "SELECT cob_dt, count(*) AS row_count, sum(txn_amount) AS txn_amount, 1 AS files FROM f_card GROUP BY cob_dt")
def compact_partitions(lake: Lake) -> DataFrame:
    """Seven small files per day become one, with the same rows."""
    path, rows = _path(lake, "compact"), _month(lake)
    sinks.append(rows.repartition(7), path, "cob_dt")
    sinks.compact(lake.spark, path, "cob_dt", min_files=5)
    files_now = sinks.file_report(lake.spark, path, "cob_dt").select("cob_dt", "files")
    totals = lake.spark.read.schema(rows.schema).parquet(path).groupBy("cob_dt").agg(F.count("*").alias("row_count"), F.sum("txn_amount").alias("txn_amount"))
    return totals.join(files_now, "cob_dt")
