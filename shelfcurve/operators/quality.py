"""Audits of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are missing or occur more than once, with their number of rows."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing)


def missing_references(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values without a parent, with their number of rows.

    Counting comes first: the join sees one row per key value.
    """
    used = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def resolve_keys(
    df: DataFrame, key: str, primary: DataFrame, secondary: DataFrame, dimension_key: str
) -> DataFrame:
    """Number of rows per key value, and where the key was found: primary, misrouted, orphan."""
    used = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))

    def found(dimension: DataFrame, flag: str) -> DataFrame:
        return dimension.select(F.col(dimension_key).alias("key"), F.lit(True).alias(flag)).distinct()

    joined = used.join(found(primary, "p"), "key", "left").join(found(secondary, "s"), "key", "left")
    status = F.when(F.col("p"), "primary").when(F.col("s"), "misrouted").otherwise("orphan")
    return joined.select("key", "n", status.alias("status"))
