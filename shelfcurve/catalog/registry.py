"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under the name of its function."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


# A mean of prices often ends in a five after the digits that are shown, and a sum of doubles
# depends on its order in the last bits. Eight decimal digits hide those bits; the rest is a
# plain rounding of decimals, half away from zero, alike in both engines.
_EXACT = "DECIMAL(28, 8)"


def four_digits(column: Column) -> Column:
    return F.round(column.cast(_EXACT.lower()), 4).cast("double")


def four_digits_sql(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS {_EXACT}), 4) AS DOUBLE)"
