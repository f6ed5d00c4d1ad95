"""Relational databases through the JDBC source. The driver jar is the cluster's to supply."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is and how to sign in."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetch_size: int = 10_000

    @staticmethod
    def sql_server(host: str, database: str, port: int = 1433, **kw) -> "JdbcTarget":
        return JdbcTarget(f"jdbc:sqlserver://{host}:{port};databaseName={database}", **kw)

    @staticmethod
    def postgres(host: str, database: str, port: int = 5432, **kw) -> "JdbcTarget":
        return JdbcTarget(f"jdbc:postgresql://{host}:{port}/{database}", **kw)

    def options(self) -> dict[str, str]:
        found = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in found.items() if v is not None} | {"fetchsize": str(self.fetch_size)}


def read_table(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 64,
) -> DataFrame:
    """A table; with a partition column it is read by many tasks instead of one."""
    options = target.options() | {"dbtable": table}
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """The result of one statement, such as ``SELECT version()``."""
    return spark.read.format("jdbc").options(**(target.options() | {"query": query})).load()


def write_table(df: DataFrame, target: JdbcTarget, table: str, *, mode: str = "append", batch: int = 10_000) -> None:
    options = target.options() | {"dbtable": table, "batchsize": str(batch)}
    df.write.format("jdbc").options(**options).mode(mode).save()
