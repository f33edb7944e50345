"""Publish the latest snapshot of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcurve.operators.filters import latest_snapshot
from shelfcurve.operators.upsert import staged_publish
from shelfcurve.session import materialise
from shelfcurve.sources import jdbc


def publish_snapshot(df: DataFrame, day: str, columns: list[str], stage_path: str, table_path: str, keys: list[str]) -> DataFrame:
    """Merge the latest snapshot into a table of versions; see ``staged_publish``."""
    newest = latest_snapshot(df, day).select(*columns)
    return staged_publish(newest, stage_path, table_path, keys)


def publish_to_database(
    df: DataFrame, day: str, columns: list[str], connection: jdbc.Connection, table: str, writers: int = 8
) -> bool:
    """Fill a staging table with the latest snapshot; says whether there was anything.

    The stage is cleared first, so a repeated run does not double it. The snapshot is written
    to the shared folder once and tested there.
    """
    newest = materialise(latest_snapshot(df, day).select(*columns), "snapshot")
    if newest.isEmpty():
        return False
    jdbc.replace(newest, connection, table, writers)
    return True
