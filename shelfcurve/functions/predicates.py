"""Boolean expressions and codes derived by case."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# Periods in which sales say nothing about prices.
BLACKOUTS = (("2020-03-09", "2020-05-03"), ("2022-02-24", "2022-03-22"))
# Price reasons and the type each stands for; any other reason is type 4.
REASON_TYPES = {21001: 1, 24062: 1, 21007: 2, 21004: 3}
OTHER_REASON = 4
# Reasons of daily sales.
MONITOR_REASON, REGULAR_REASON, PROMO_REASONS = 21004, 24185, (24062, 21001)
# Regions that count as another region.
REGION_REMAP = {1071315: 481752, 482104: 481752, 482364: 481965}


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def all_positive(*columns: str) -> Column:
    return all_of(F.col(c) > 0 for c in columns)


def outside_periods(columns: Iterable[str], periods=BLACKOUTS) -> Column:
    """True if no date falls into any of the closed periods."""
    return all_of(
        ~F.col(c).between(F.lit(a).cast("date"), F.lit(b).cast("date")) for c in columns for a, b in periods
    )


def remap(value: Column, mapping: dict) -> Column:
    """Replace listed values, keep the others."""
    return classify(value, mapping, value)


def classify(value: Column, mapping: dict, default) -> Column:
    """Code for listed values, one default for all others and for NULL."""
    code = None
    for old, new in mapping.items():
        code = F.when(value == old, new) if code is None else code.when(value == old, new)
    return code.otherwise(default)
