"""The history of table profiles: one row per table and time, kept for good."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_profiles(profiles: DataFrame, path: str) -> None:
    """Add profiles (table_name, taken_at, ...) to the history at ``path``.

    Each table and time is a partition. A run that repeats replaces its own rows only, so a profile
    is never kept twice. Profiles have a row per table: one file each.
    """
    (
        profiles.repartition("table_name", "taken_at")
        .write.partitionBy("table_name", "taken_at")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All profiles; columns that came later are NULL before."""
    history = spark.read.option("mergeSchema", True).parquet(path)
    return history.withColumn("taken_at", history["taken_at"].cast("date"))
