"""Grouped operators. All combine on the map side, so hot groups shrink before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def mean_and_spread(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean and population standard deviation of each value."""
    aggs = [
        agg
        for v in values
        for agg in (F.avg(v).alias(f"avg_{v}"), F.stddev_pop(v).alias(f"std_{v}"))
    ]
    return df.groupBy(*keys).agg(*aggs)


def flagged_profile(df: DataFrame, keys: list[str], disc: str, metrics: dict[str, Column]) -> DataFrame:
    """Mean discount, spread, count and mean of each metric over the rows of its flag."""
    aggs = []
    for metric, flag in metrics.items():
        chosen = F.when(flag, F.col(metric))
        aggs += [
            F.avg(F.when(flag, F.col(disc).cast("double"))).alias(f"av_disc_{metric}"),
            F.stddev_pop(chosen).alias(f"std_{metric}"),
            F.sum(F.when(flag, 1).otherwise(0)).alias(f"cnt_{metric}"),
            F.avg(chosen).alias(f"avg_{metric}"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def quality_gate(
    groups: DataFrame,
    spread: str,
    mean: str,
    count: str,
    max_spread: float = 0.5,
    loose_points: int = 200,
    min_points: int = 10,
    digits: int = 6,
) -> DataFrame:
    """Groups with enough points whose relative spread is small, or with very many points."""
    relative = F.round(F.try_divide(F.col(spread), F.col(mean) + 1), digits)
    n = F.col(count)
    return groups.where(((relative < max_spread) | (n >= loose_points)) & (n >= min_points))


def active_days(df: DataFrame, keys: list[str], day: str, min_days: int, name: str = "days") -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(day).alias(name)).where(F.col(name) >= min_days)


def factor_product(df: DataFrame, keys: list[str], log_factor: str, name: str) -> DataFrame:
    """Product of factors given as logarithms."""
    return df.groupBy(*keys).agg(F.exp(F.sum(log_factor)).alias(name))


def collapse_by_max(df: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(a).alias(a) for a in attributes])


def weighted_log_fit(
    points: DataFrame, keys: list[str], x: Column, growth: Column, count: Column, max_points: float = 15000.0
) -> DataFrame:
    """Weighted least squares of ln(growth + 1) on x: exp_trend_a - exp_trend_b * x.

    The weight is the number of rows behind a point, at most ``max_points``. A common factor
    of the weights cancels out, so the largest count of the group is not needed and one
    aggregate is enough.
    """
    w = F.least(count.cast("double"), F.lit(max_points))
    y = F.ln(growth + 1)
    sums = points.groupBy(*keys).agg(
        F.sum(w).alias("sw"),
        F.sum(w * x).alias("swx"),
        F.sum(w * x * x).alias("swxx"),
        F.sum(w * y).alias("swy"),
        F.sum(w * x * y).alias("swxy"),
        F.count("*").alias("disc_group_cnt"),
        F.min("av_disc").alias("min_discount"),
        F.max("av_disc").alias("max_discount"),
        F.avg("stddev_koeff").alias("avg_stddev"),
        F.max("stddev_koeff").alias("max_stddev"),
        F.sum("cnt_int_rows").alias("sum_cnt_int_rows"),
        F.min("cnt_int_rows").alias("min_cnt_int_rows"),
    )
    sw, swx, swxx, swy, swxy = (F.col(c) for c in ("sw", "swx", "swxx", "swy", "swxy"))
    b = F.try_divide(swy * swx - swxy * sw, swxx * sw - swx * swx)
    fitted = sums.withColumn("exp_trend_b", b)
    a = F.try_divide(F.col("exp_trend_b") * swx + swy, sw)
    return fitted.withColumn("exp_trend_a", a).drop("sw", "swx", "swxx", "swy", "swxy")


def nearest_value(
    df: DataFrame, keys: list[str], value: str, target: float, position: list[str], reach: float, default: Column
) -> DataFrame:
    """Value nearest to a target within ``reach``; of equally near ones the last by position."""
    distance = F.abs(F.col(value) - target)
    place = F.struct(distance, *[-F.col(p) for p in position])
    nearest = F.min_by(F.when(distance <= reach, F.col(value)), F.when(distance <= reach, place))
    return df.groupBy(*keys).agg(F.coalesce(nearest, default).alias("nearest"))


# Bytes of the types of fixed width.
TYPE_BYTES = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
    "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8,
}


def table_profile(df: DataFrame, name: str, taken: Column) -> DataFrame:
    """One row about a table: its number of rows and its mean row size in bytes."""
    fixed = sum(TYPE_BYTES.get(dtype, 0) for _, dtype in df.dtypes)
    size = F.lit(fixed)
    for column, dtype in df.dtypes:
        if dtype == "string":
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return df.agg(F.count("*").alias("row_count"), F.avg(size).alias("avg_row_size")).select(
        F.lit(name).alias("table_name"), taken.alias("taken_at"), "row_count", "avg_row_size"
    )
