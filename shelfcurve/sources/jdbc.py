"""JDBC source and sink. Address, user and driver come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}


def subquery(sql: str, alias: str = "src") -> str:
    """A query in the place of a table name: the database runs it."""
    return f"({sql.strip().rstrip(';')}) {alias}"


def modulus_options(column: str, modulus: int) -> dict[str, str]:
    """One reader per remainder of a modulus column.

    The upper bound is the modulus itself: with the largest remainder as the bound Spark
    would cut one range fewer.
    """
    return {
        "partitionColumn": column,
        "lowerBound": "0",
        "upperBound": str(modulus),
        "numPartitions": str(modulus),
    }


def read_subquery(spark: SparkSession, connection: Connection, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connection.options(), dbtable=subquery(sql)).load()


def read_by_modulus(
    spark: SparkSession, connection: Connection, sql: str, key: str, modulus: int = 10, column: str = "mdn"
) -> DataFrame:
    """Read a query in parallel, split by ``key`` modulo ``modulus``."""
    split_sql = f"SELECT a.*, MOD(a.{key}, {modulus}) AS {column} FROM {subquery(sql, 'a')}"
    options = {**connection.options(), **modulus_options(column, modulus)}
    return spark.read.format("jdbc").options(**options, dbtable=subquery(split_sql)).load().drop(column)


def replace(df: DataFrame, connection: Connection, table: str, writers: int | None = None) -> None:
    """Clear a table and fill it; its definition and grants stay."""
    out = df.repartition(writers) if writers else df
    options = {**connection.options(), "truncate": "true"}
    out.write.format("jdbc").options(**options, dbtable=table).mode("overwrite").save()


def append(df: DataFrame, connection: Connection, table: str, writers: int | None = None) -> None:
    """Append rows to a table; ``writers`` sets the number of parallel connections."""
    out = df.repartition(writers) if writers else df
    out.write.format("jdbc").options(**connection.options(), dbtable=table).mode("append").save()
