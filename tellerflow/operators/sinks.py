"""Write strategies over partitioned Parquet, safe to rerun."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tellerflow.schemas import Table, assert_schema
from tellerflow.session import shared_dir

PACKED = "zstd"  # of stored tables: the digits of a surrogate key take half the bytes


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path, so that any store Spark can write also works here."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, jsource = _fs(spark, source)
    if not fs.rename(jsource, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise RuntimeError(f"could not rename {source} to {target}")


_SCRATCH: list[str] = []  # folders of the runs going on, the innermost last


@contextlib.contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A run's own folder for its intermediate tables, deleted when the run ends, also by a failure."""
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(folder)
    try:
        yield folder
    finally:
        _SCRATCH.remove(folder)
        remove(spark, folder)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so a lost executor costs no recomputation.

    Within a ``scratch`` run the table goes with the run; elsewhere it stays as
    long as the caller's shared folder.
    """
    top = _SCRATCH[-1] if _SCRATCH else shared_dir(df.sparkSession)
    path = f"{top}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Tasks for an explicit shuffle of a frame: one per ``target_bytes`` that its scans read, and at least the session's
    shuffle partitions. Estimates above the scans are left out, as joins multiply them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(size for size in sizes if size < 1 << 60)  # an unknown size is given as very large
    return max(least, -(-read // target_bytes))


def overwrite_partitions(df: DataFrame, path: str, partition: str | list[str] = "cob_dt") -> None:
    """Replace only the partitions present in the output."""
    columns = [partition] if isinstance(partition, str) else partition
    df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression=PACKED).partitionBy(*columns).parquet(path)


def load_partitions(df: DataFrame, path: str, partition: str = "cob_dt") -> None:
    """First load of many partitions: into an empty place the rows are written directly, a reload replaces its partitions."""
    if exists(df.sparkSession, path):
        overwrite_partitions(df, path, partition)
    else:
        df.write.option("compression", PACKED).partitionBy(partition).parquet(path)


def by_day(rows: DataFrame, key: str) -> DataFrame:
    """Cluster a load of many days before it is written: few files per day, row groups that a date filter can skip,
    and a hot day split over tasks by key.

    The partition count is explicit because the cost here is files, not bytes: left to itself, adaptive execution
    would join a small load of many days into one task that opens every file.
    """
    return rows.repartitionByRange(partitions_for(rows), "cob_dt", key)


def overwrite_day(df: DataFrame, path: str, day: dt.date, partition: str = "cob_dt") -> int:
    """Replace exactly one partition, also when the output is empty. Returns the rows written."""
    written = Observation()
    rows = df.where(F.col(partition) == F.lit(day)).observe(written, F.count(F.lit(1)).alias("n"))
    overwrite_partitions(rows, path, partition)
    count = written.get["n"]
    if not count:  # a dynamic overwrite leaves a partition alone when nothing is written to it
        remove(df.sparkSession, f"{path}/{partition}={day.isoformat()}")
    return count


def restore(spark: SparkSession, path: str) -> None:
    """Put right what a stopped ``overwrite_all`` left: the old table returns if the path is empty, else it goes."""
    fs, pattern = _fs(spark, f"{path}__old_*")
    for status in fs.globStatus(pattern) or []:
        old = status.getPath().toString()
        if exists(spark, path):
            remove(spark, old)
        else:
            _rename(spark, old, path)


def overwrite_all(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a whole table through a staging folder; the table may be among its own inputs.

    A run stopped between the two renames leaves the old table beside the path;
    ``restore``, called here first and by whoever asks whether the table exists,
    brings it back.
    """
    spark = df.sparkSession
    restore(spark, path)
    stage, old = f"{path}__stage_{uuid.uuid4().hex[:8]}", f"{path}__old_{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(stage)
    if exists(spark, path):
        _rename(spark, path, old)
    _rename(spark, stage, path)
    remove(spark, old)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def write_checked(df: DataFrame, table: Table, path: str, strategy: Callable[[DataFrame, str], object]) -> None:
    """Any strategy behind the declared schema; an absent table is created empty first."""
    rows = assert_schema(df, table)
    spark = df.sparkSession
    if not exists(spark, path):
        spark.createDataFrame([], table.struct).write.parquet(path)
    strategy(rows, path)


def read_evolved(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Read files written before columns were added; the missing ones are NULL."""
    return spark.read.schema(table.struct).parquet(path)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive evolution within one plan."""
    return new.unionByName(old, allowMissingColumns=True)


# --- compaction ----------------------------------------------------------------------------------


def _as_named(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """A partitioned table with the partition's values as its folders name them: ``007`` does not become 7."""
    found = spark.read.parquet(path).schema
    fields = [StructField(partition, StringType()) if f.name == partition else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def file_report(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Files and bytes per partition, from the hidden file metadata of the scan."""
    files = _as_named(spark, path, partition).select(
        partition, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    )
    return (
        files.groupBy(partition, "file").agg(F.first("bytes").alias("bytes"))
        .groupBy(partition).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive one-row fingerprint; mergeable, so no task ever sees the whole list."""
    value = F.xxhash64(*[F.col(c) for c in (columns or df.columns)])
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor(value), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0)).alias("sum_hash"),
    )


def compact(spark: SparkSession, path: str, partition: str, target_bytes: int = 128 << 20, min_files: int = 5) -> DataFrame:
    """Rewrite partitions that hold many small files into files near the target size; gives what was rewritten.

    A partition of b bytes becomes ceil(b / target) files: its rows are dealt by
    their hash to that many tasks, and no task writes more than one file. Rows
    are staged before they replace the old files, and the files finally written
    are compared with the rows there were.
    """
    report = file_report(spark, path, partition).where(F.col("files") >= min_files)
    report = report.withColumn("pieces", F.ceil(F.col("bytes") / target_bytes).cast("int"))
    numbered = Window.orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    todo = durable(report.withColumn("first", F.coalesce(F.sum("pieces").over(numbered), F.lit(0)).cast("int")), "compaction-plan")
    pieces = todo.agg(F.sum("pieces")).first()[0]
    if not pieces:
        return todo.drop("first")

    def chosen() -> DataFrame:
        table = _as_named(spark, path, partition)
        return table.join(todo.select(partition), partition, "left_semi").select(*table.columns)

    before = fingerprint(chosen()).first()
    stage = durable(chosen(), "compaction-stage")
    slot = F.col("first") + F.pmod(F.xxhash64(*stage.columns), F.col("pieces")).cast("int")
    dealt = stage.join(todo.select(partition, "pieces", "first"), partition).withColumn("_slot", slot)
    overwrite_partitions(dealt.repartitionById(int(pieces), F.col("_slot")).select(*stage.columns), path, partition)
    if fingerprint(chosen()).first() != before:
        raise RuntimeError(f"{path}: compaction changed the rows; they are kept in {stage.inputFiles()[0].rsplit('/', 1)[0]}")
    return todo.drop("first")


def compact_tables(spark: SparkSession, tables: dict[str, tuple[str, str]], **options: int) -> dict[str, int]:
    """Compact several tables; go on after an error and name all failures at the end."""
    done, failed = {}, {}
    for name, (path, partition) in tables.items():
        try:
            done[name] = compact(spark, path, partition, **options).count()
        except Exception as error:  # noqa: BLE001 - collected and raised below
            failed[name] = f"{type(error).__name__}: {error}"
    if failed:
        raise RuntimeError(f"compaction failed for {failed}")
    return done

