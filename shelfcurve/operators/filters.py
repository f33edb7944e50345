"""Row filters and updates of single tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def trailing_window(df: DataFrame, day: str, days: int, latest_of: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``days`` days before the latest day, as one scalar subquery."""
    horizon = (df if latest_of is None else latest_of).agg(F.date_sub(F.max(day), days)).scalar()
    return df.where(F.col(day) >= horizon)


def window_before(df: DataFrame, day: str, today: Column, days: int) -> DataFrame:
    """Rows from ``days`` days before ``today`` up to yesterday."""
    return df.where(F.col(day).between(F.date_sub(today, days), F.date_sub(today, 1)))


def latest_snapshot(df: DataFrame, day: str) -> DataFrame:
    """Rows of the latest day only."""
    return df.where(F.col(day) == df.agg(F.max(day)).scalar())


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete rows; a condition that is NULL does not delete."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def update_flag(df: DataFrame, flag: str, value, selected: Column) -> DataFrame:
    return df.withColumn(flag, F.when(selected, F.lit(value)).otherwise(F.col(flag)))
