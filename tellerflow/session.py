"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Results do not depend on these settings; they only steer physical planning.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# The most that a size estimated from files may broadcast. Packed files hold many times their size in rows, and the
# driver holds every broadcast as rows; a measured size needs no such margin.
ESTIMATED_BROADCAST = 256 << 10


def local_session(app: str = "tellerflow", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bound_broadcasts(spark: SparkSession) -> None:
    """Broadcast by measured size: adaptive execution keeps the session's threshold, estimates get a far smaller one.

    A threshold that the caller has set lower, or has set for adaptive execution, stays.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if most <= ESTIMATED_BROADCAST:
        return
    if spark.conf.get(measured, None) is None:
        spark.conf.set(measured, str(most))
    spark.conf.set(planned, str(ESTIMATED_BROADCAST))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tellerflow-")
    context.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
