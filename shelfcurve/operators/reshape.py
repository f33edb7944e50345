"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pivot_max(df: DataFrame, keys: list[str], column: str, value: str, values: list) -> DataFrame:
    """One column per listed value. The list is given, so no extra job looks for it."""
    return df.groupBy(*keys).pivot(column, values).agg(F.max(value))


def pivot_case(df: DataFrame, keys: list[str], column: str, value: str, names: dict) -> DataFrame:
    """The same by conditional aggregates; ``names`` maps values to column names."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(column) == v, F.col(value))).alias(name) for v, name in names.items()]
    )


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row per cell; empty cells are left out."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())
