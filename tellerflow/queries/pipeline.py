"""Run log and pipeline (OP)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.lake import SALT, SCD1, Lake
from tellerflow.operators import asof, sinks
from tellerflow.plans import acceptance
from tellerflow.plans.pipeline import ERROR_TEXT, Pipeline
from tellerflow.queries.registry import query
from tellerflow.sources import bank

col, lit = F.col, F.lit


def run_log_rows(lake: Lake) -> DataFrame:
    """The given event stream read as job events: one job per user, one pipeline run per day."""
    kind, day = col("event_type"), col("ts").cast("date")
    status = F.when(kind == "error", "F").when(kind.isin("click", "signup"), "R").otherwise("S")
    error = F.when(kind == "error", F.substring(F.concat(lit("failed: "), F.repeat("props", 400)), 1, ERROR_TEXT))
    job = F.concat(lit("job-"), col("user_id"))
    rows = lake.raw("events").select(
        col("event_id").alias("id"), job.alias("job_name"), lit("silver").alias("schema_name"), job.alias("table_name"), status.alias("status"),
        F.when(status == "R", col("ts").cast("timestamp")).alias("start_time"), F.when(status != "R", col("ts").cast("timestamp")).alias("end_time"),
        day.alias("cob_dt"), F.concat(lit("dag-"), day).alias("dag_run_id"), F.concat(lit("daily-"), day).alias("pipeline_run_id"),
        (col("event_id") % 3 + 1).cast("int").alias("try_number"), error.alias("error_detail"), col("ts").cast("timestamp").alias("created_at"),
    )
    return S.assert_schema(rows, S.RUN_LOG_TABLE)


RUN_LOG_SQL = """
SELECT event_id AS id, 'job-' || user_id AS job_name, CASE event_type WHEN 'error' THEN 'F' WHEN 'click' THEN 'R' WHEN 'signup' THEN 'R' ELSE 'S' END AS status,
  CAST(ts AS DATE) AS cob_dt, 'dag-' || CAST(ts AS DATE) AS dag_run_id, 'daily-' || CAST(ts AS DATE) AS pipeline_run_id, event_id % 3 + 1 AS try_number,
  CASE event_type WHEN 'error' THEN substr('failed: ' || repeat(props, 400), 1, 4000) END AS error_detail FROM events"""


@query("run_log_append", f"SELECT * FROM ({RUN_LOG_SQL})")
def run_log_append(lake: Lake) -> DataFrame:
    """Events appended in two batches; nothing already written changes."""
    path = f"{lake.root}/run-log-{uuid.uuid4().hex[:8]}"
    rows = run_log_rows(lake)
    sinks.append(rows.where(col("cob_dt") < lit(lake.day)), path)
    sinks.append(rows.where(col("cob_dt") == lit(lake.day)), path)
    stored = lake.spark.read.parquet(path)
    return stored.select("id", "job_name", "status", "cob_dt", "dag_run_id", "pipeline_run_id", "try_number", "error_detail")


@query("run_log_latest_ok", f"""
SELECT job_name, cob_dt, pipeline_run_id, status, CAST(status = 'S' AS INTEGER) AS ok FROM ({RUN_LOG_SQL})
QUALIFY row_number() OVER (PARTITION BY job_name, cob_dt, pipeline_run_id ORDER BY id DESC) = 1""")
def run_log_latest_ok(lake: Lake) -> DataFrame:
    rows = acceptance.latest_status(run_log_rows(lake))
    return rows.select("job_name", "cob_dt", "pipeline_run_id", "status", (col("status") == "S").cast("int").alias("ok"))


_EVENTS = {"txn_account": "(SELECT count(*) FROM lineitem)", "card_txn": "(SELECT count(*) FROM events)", "crm_interaction": "(SELECT count(*) FROM events)"}
_KEYS = {"branch": ("nation", "n_nationkey"), "product": ("part", "p_partkey"), "customer": ("customer", "c_custkey"), "account": ("orders", "o_orderkey")}


def _n(entity: str, where: str = "true") -> str:
    table, key = _KEYS[entity]
    return f"(SELECT count(*) FROM (SELECT {key} AS k FROM {table}) WHERE {where})"


_CUSTOMERS = f"{_n('customer')} * 2 + {_n('customer', 'k % 23 = 0')}"
_PIPELINE_SQL = " UNION ALL ".join(
    [f"SELECT 'dim_{e}' AS table_name, {_n(e)} + {_n(e, 'k % 10 = 1')} + {_n(e, 'k % 23 = 0')} AS row_count, {_n(e)} + {_n(e, 'k % 23 = 0')} AS current_rows" for e in _KEYS]
    + [f"SELECT '{asof.FACTS[f].name}', {n}, NULL" for f, n in _EVENTS.items()]
    + [f"SELECT '{n}', {_CUSTOMERS}, NULL" for n in ("customer_360", "rfm_segment", "campaign_target", "mart_customer_360_dashboard")]
    + [f"SELECT 'mart_customer_360', {_n('customer')} + {_n('customer', 'k % 23 = 0')}, NULL",
       "SELECT 'dq_result_failed_critical', 0, NULL", "SELECT 'run_log_not_ok', 0, NULL"]
)


@query("run_pipeline", _PIPELINE_SQL)
def run_pipeline(lake: Lake) -> DataFrame:
    """Two processing dates over stored tables; the second day deletes no keys, so the gate lets it pass."""

    def feed(entity: str, day) -> DataFrame:
        base = lake.feed(entity)
        if entity in asof.FACTS:
            return base
        second = day > lake.base
        if entity in SCD1:
            return bank.scd1_day(base, *SCD1[entity], second)
        return bank.second_day(entity, base, deletes=False) if second else base

    job = Pipeline(lake.spark, f"{lake.root}/pipeline-{uuid.uuid4().hex[:8]}", feed, SALT)
    job.run(lake.base, "day-1", initial=True)
    job.run(lake.day, "day-2")
    parts = []
    tables = {**{f"dim_{e}": ("silver", f"dim_{e}") for e in _KEYS}, **{asof.FACTS[f].name: ("silver", asof.FACTS[f].name) for f in _EVENTS},
              **{n: ("gold", n) for n in ("customer_360", "rfm_segment", "campaign_target", "mart_customer_360")},
              "mart_customer_360_dashboard": ("sandbox", "mart_customer_360_dashboard")}
    for name, (layer, table) in tables.items():
        df = job.read(layer, table)
        current = F.count_if(col("is_current") == 1) if name.startswith("dim_") else lit(None).cast("long")
        parts.append(df.agg(F.count("*").alias("row_count"), current.alias("current_rows")).withColumn("table_name", lit(name)))
    none = lit(None).cast("long").alias("current_rows")
    failed = job.read("ops", "dq_result").agg(F.count_if(~col("passed") & (col("severity") == "critical")).alias("row_count"), none)
    open_jobs = acceptance.latest_status(job.read("ops", "run_log")).agg(F.count_if(col("status") != "S").alias("row_count"), none)
    parts += [failed.withColumn("table_name", lit("dq_result_failed_critical")), open_jobs.withColumn("table_name", lit("run_log_not_ok"))]
    return acceptance.stack(parts)
