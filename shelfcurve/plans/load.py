"""Load a day's slice of an external table into a table partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcurve.sources import jdbc, writers


def load_partitioned(df: DataFrame, columns: list[str], path: str, day: str = "day_id") -> DataFrame:
    return writers.append_partitioned(df.select(*columns), path, day)


def load_from_database(
    spark: SparkSession, connection: jdbc.Connection, sql: str, split_key: str, columns: list[str], path: str,
    modulus: int = 10, day: str = "day_id",
) -> DataFrame:
    """Parallel read by modulus, then a partitioned append."""
    source = jdbc.read_by_modulus(spark, connection, sql, split_key, modulus)
    return load_partitioned(source, columns, path, day)
