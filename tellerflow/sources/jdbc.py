"""Options for Spark's JDBC source and sink.

Only option building lives here; Spark opens the connections on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

# Driver class by URL prefix.
DRIVERS = {
    "jdbc:oracle:": "oracle.jdbc.OracleDriver",
    "jdbc:postgresql:": "org.postgresql.Driver",
    "jdbc:mysql:": "com.mysql.cj.jdbc.Driver",
    "jdbc:sqlserver:": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}


@dataclass(frozen=True)
class Partitioning:
    """Numeric split of a scan into parallel range queries."""

    column: str
    lower: int
    upper: int
    parts: int

    def validate(self) -> None:
        if not self.column or self.parts < 1 or self.lower >= self.upper:
            raise ValueError(f"invalid partitioned scan: {self}")


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str
    password: str
    fetchsize: int = 10_000

    @property
    def driver(self) -> str:
        for prefix, name in DRIVERS.items():
            if self.url.startswith(prefix):
                return name
        raise ValueError(f"no JDBC driver known for {self.url.split('//')[0]}")

    def options(self, fetchsize: int | None = None) -> dict[str, str]:
        """A table's own fetch size beats the global one."""
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(fetchsize or self.fetchsize),
        }


def scan_options(source: JdbcSource, sql: str, fetchsize: int | None = None, split: Partitioning | None = None) -> dict[str, str]:
    options = source.options(fetchsize) | {"dbtable": f"({sql.strip().rstrip(';')}) t"}
    if split:
        split.validate()
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def scan(spark: SparkSession, source: JdbcSource, sql: str, fetchsize: int | None = None,
         split: Partitioning | None = None) -> DataFrame:
    """Run a source query as a subquery, optionally split on a numeric column."""
    return spark.read.format("jdbc").options(**scan_options(source, sql, fetchsize, split)).load()


def query_scan(spark: SparkSession, source: JdbcSource, sql: str, view: str) -> DataFrame:
    """Read an operational table through the query option and register it as a view."""
    reader: DataFrameReader = spark.read.format("jdbc").options(**source.options()).option("query", sql)
    df = reader.load()
    df.createOrReplaceTempView(view)
    return df


def append(df: DataFrame, target: JdbcSource, table: str) -> None:
    df.write.format("jdbc").options(**target.options()).option("dbtable", table).mode("append").save()
