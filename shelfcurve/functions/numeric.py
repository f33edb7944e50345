"""Numeric expressions. Division goes through try_divide: a zero divisor gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PRICE = "decimal(18,6)"  # fixed value: the type of prices and discounts


def discount(first_price: Column, second_price: Column) -> Column:
    """Relative price change, as a decimal with six digits."""
    ratio = F.try_divide(second_price.cast(PRICE), first_price.cast(PRICE))
    return (ratio - F.lit(1).cast(PRICE)).cast(PRICE)


def discount_bin(disc: Column) -> Column:
    """Discount bin in per mille: 2.5% wide, 5% beyond one half, 10% beyond 80%."""
    depth = F.abs(F.round(disc, 5))

    def edge(steps: int, width: int) -> Column:
        return F.floor(F.round(disc * steps, 5)).cast("bigint") * width

    return F.when(depth > 0.8, edge(10, 100)).when(depth > 0.5, edge(20, 50)).otherwise(edge(40, 25))


def growth(first: Column, second: Column, first_base: Column, second_base: Column) -> Column:
    """Growth of a quantity whose bases differ, e.g. the number of days."""
    return F.try_divide(second, first) * F.try_divide(first_base, second_base) - 1


def seasonal_growth(first: Column, second: Column, coefficient: Column) -> Column:
    """Growth after the seasonal coefficient; NULL where the coefficient is zero."""
    return F.try_divide(second, first * F.nullif(coefficient, F.lit(0.0))) - 1


def clamp(value: Column, bound: float = 35.0) -> Column:
    """Limit to [-bound, bound]; NULL stays NULL."""
    return F.when(value > bound, bound).when(value < -bound, -bound).otherwise(value)


def cap(value: Column, top: float = 200.0) -> Column:
    return F.when(value > top, top).otherwise(value)


def floored_exp(log_value: Column, floor: float = 0.5) -> Column:
    """exp with a lower limit; NULL stays NULL."""
    return F.when(F.exp(log_value) < floor, floor).otherwise(F.exp(log_value))


def compare_code(a: Column, b: Column) -> Column:
    """0 if equal, 1 if the first is greater, else 2."""
    return F.when(a == b, 0).when(a > b, 1).otherwise(2)


def quotient(a: Column, b: int) -> Column:
    """Whole quotient, truncated toward zero."""
    return F.call_function("div", a, F.lit(b))


def positive_part(value: Column) -> Column:
    return F.when(value > 0, value).otherwise(0.0)


def growth_coefficient(a: Column, b: Column, disc: Column, bound: float = 35.0, top: float = 200.0) -> Column:
    """Growth factor of sales at a discount, from the trend ln(growth + 1) = a + b * discount.

    A discount of zero or more raises sales; a negative one (a price above the regular
    price) lowers them by the reciprocal of the growth that its counterpart would give.
    """
    a, b = clamp(a, bound), clamp(b, bound)
    at_discount = F.exp(clamp(a + b * disc, bound))
    at_increase = F.exp(clamp(a - F.try_divide(b * disc, 1 - disc), bound))
    raised = at_discount - F.exp(a) + 1
    lowered = F.try_divide(F.lit(1.0), at_increase - F.exp(a) + 1)
    return cap(F.when(disc >= 0, raised).otherwise(lowered), top)


def with_growth_coefficient(
    df: DataFrame, name: str, a: str, b: str, disc: str, bound: float = 35.0, top: float = 200.0
) -> DataFrame:
    """``growth_coefficient`` of columns in steps. Each limit names its value several times; as one
    expression they multiply to a method too large for the JVM to compile."""
    a_, b_, d, x, y = (F.col(c) for c in ("_a", "_b", disc, "_x", "_y"))
    raised, lowered = a_ + b_ * d, a_ - F.try_divide(b_ * d, 1 - d)
    return (
        df.withColumns({"_a": clamp(F.col(a), bound), "_b": clamp(F.col(b), bound)})
        .withColumn("_x", F.when(d >= 0, raised).otherwise(lowered))
        .withColumn("_x", clamp(x, bound))
        .withColumn("_y", F.exp(x) - F.exp(a_) + 1)
        .withColumn("_y", F.when(d >= 0, y).otherwise(F.try_divide(F.lit(1.0), y)))
        .withColumn(name, cap(y, top))
        .drop("_a", "_b", "_x", "_y")
    )
