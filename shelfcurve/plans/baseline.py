"""Sales at the regular price, per warehouse and article.

Daily sales are freed of season and holidays and divided by the growth that the article's
elasticity predicts for the discount of the day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcurve.functions import dates, numeric, predicates
from shelfcurve.operators import aggregates, joins, windows
from shelfcurve.operators.filters import delete_where, window_before
from shelfcurve.session import materialise, materialise_buckets

PAIR = ["whs_id", "art_id"]
PAIR_DAY = [*PAIR, "day_id"]
MEASURES = ["sales_qnty", "rest_qnty", "sale", "disc_loyal", "disc_ma_qnty", "action_type_id"]
FACTOR_GROUP = ["frmt_id", "branch_id", "cluster_id", "art_grp_lvl_3_id"]

# Level-0 groups that are not forecast.
EXCLUDED_GROUPS = (
    1876, 535, 1916, 17415, 115, 637, 1266, 1561, 14257, 1009, 17191, 16864, 17241, 417, 367, 1298,
    1594, 1268,
)


@dataclass(frozen=True)
class Settings:
    today: Column
    days: int = 84
    formats: tuple = (2,)
    excluded_groups: tuple = EXCLUDED_GROUPS
    companies: tuple = (1,)
    promo_days: str = "keep"  # "keep": promo days only, "exclude": all other days
    min_days: int = 14
    min_promo_days: int = 7
    promo_discount: float = 0.05
    discount_from: str = "share"  # "share": 1 - target / regular, "reciprocal": 1 / target / regular


@dataclass(frozen=True)
class Inputs:
    sales: DataFrame
    prices: DataFrame
    reasons: DataFrame
    warehouses: DataFrame
    clusters: DataFrame
    articles: DataFrame
    article_info: DataFrame
    calendar: DataFrame
    holidays: DataFrame
    seasons: DataFrame
    elasticity: DataFrame


def sales_in_window(sales: DataFrame, s: Settings) -> DataFrame:
    rows = window_before(sales, "day_id", s.today, s.days)
    return rows.where((F.coalesce("rest_qnty", F.lit(0)) > 0) | (F.coalesce("sales_qnty", F.lit(0)) > 0))


def promo_days(calendar: DataFrame, s: Settings) -> DataFrame:
    first, last = F.date_sub(s.today, s.days), F.date_sub(s.today, 1)
    listed = calendar.where(F.col("market_company_id").isin(*s.companies))
    return joins.interval_days(listed, PAIR, "beg_dt", "end_dt", first, last)


def eligible_pairs(inputs: Inputs, sales: DataFrame, s: Settings) -> DataFrame:
    """Pairs with enough days of sales or stock, with the attributes of both sides."""
    shops = inputs.warehouses.where(F.col("frmt_id").isin(*s.formats)).select("whs_id", "frmt_id", "branch_id")
    goods = inputs.articles.where(~F.col("art_grp_lvl_0_id").isin(*s.excluded_groups))
    counted = aggregates.active_days(sales, PAIR, "day_id", s.min_days, "days_wsr")
    pairs = counted.join(shops, "whs_id").join(goods.select("art_id", "art_grp_lvl_3_id"), "art_id")
    pairs = joins.left_with_defaults(pairs, inputs.clusters, ["whs_id"], {"cluster_id": 1})
    return pairs.select(*PAIR, *FACTOR_GROUP)


def with_elasticity(pairs: DataFrame, elasticity: DataFrame) -> DataFrame:
    """Trend of the article in its format, else over all formats. Pairs without one go."""
    trends, order = ["exp_trend_a", "exp_trend_b"], ["exp_trend_a", "exp_trend_b"]
    table = elasticity.select("art_id", "frmt_id", *[F.col(t).cast("double").alias(t) for t in trends])
    specific = windows.first_per_key(table, ["art_id", "frmt_id"], order)
    generic = windows.first_per_key(table.where("frmt_id = -1"), ["art_id"], order)
    found = joins.lookup_with_fallback(pairs, specific, generic, ["art_id", "frmt_id"], ["art_id"], trends)
    found = delete_where(found, F.col("exp_trend_a").isNull() | F.col("exp_trend_b").isNull())
    return aggregates.collapse_by_max(found, PAIR, [*FACTOR_GROUP, *trends])


def holiday_factors(coefficients: DataFrame) -> DataFrame:
    return aggregates.factor_product(coefficients, [*FACTOR_GROUP, "day_id"], "koeff_holiday", "coef_holiday")


def season_factors(coefficients: DataFrame) -> DataFrame:
    """Mean factor per day of the year."""
    return coefficients.groupBy(*FACTOR_GROUP, "yearday_id").agg(
        F.avg(numeric.floored_exp(F.col("koef_yearly"))).alias("coef_season")
    )


def with_factors(rows: DataFrame, holidays: DataFrame, seasons: DataFrame, s: Settings) -> DataFrame:
    """Both factors of a row's group and day. They are as many as groups and days, whatever the rows:
    stored, so that the planner sees how few and need not move the rows."""
    season = materialise(season_factors(seasons), "seasons", plain=True)
    holiday = holiday_factors(window_before(holidays, "day_id", s.today, s.days))
    holiday = materialise(holiday, "holidays", plain=True)
    dated = rows.withColumn("yearday_id", dates.year_day(F.col("day_id")))
    joined = dated.join(season, [*FACTOR_GROUP, "yearday_id"], "left").drop("yearday_id")
    return joined.join(holiday, [*FACTOR_GROUP, "day_id"], "left")


def sale_reason(reason: Column, factual: Column, regular: Column, promo_discount: float) -> Column:
    """0 regular price day by reason but discounted, 1 promo reason without discount, 2 other."""
    code = F.coalesce(reason, F.lit(predicates.REGULAR_REASON))
    depth = 1 - F.try_divide(factual, F.coalesce(regular, F.lit(0.0)))
    return (
        F.when(code.isin(*predicates.PROMO_REASONS) & (depth < promo_discount), 1)
        .when((code == predicates.REGULAR_REASON) & (depth >= promo_discount), 0)
        .otherwise(2)
    )


def on_promo_days(rows: DataFrame, promo: DataFrame, s: Settings) -> DataFrame:
    return rows.join(promo, PAIR_DAY, "left_semi" if s.promo_days == "keep" else "left_anti")


def with_prices(sales: DataFrame, prices: DataFrame, s: Settings) -> DataFrame:
    days = window_before(prices, "day_id", s.today, s.days)
    return sales.join(days.select(*PAIR_DAY, "factual_price", "regular_price"), PAIR_DAY, "left")


def with_reasons(sales: DataFrame, reasons: DataFrame, s: Settings) -> DataFrame:
    """Days with prices, as what the frame needs of them: kinds of the day's reason, and of all sums
    and prices the price that was paid and the regular one."""
    reason = F.coalesce("reason_type_id", F.lit(predicates.REGULAR_REASON))
    opsum, is_txn_disc = F.col("sale") + F.coalesce("disc_loyal", F.lit(0)), F.lit(0)
    paid = F.when(F.col("sales_qnty") != 0, F.try_divide(opsum, F.col("sales_qnty"))).otherwise(F.col("factual_price"))
    return sales.join(reasons, "action_type_id", "left").select(
        *PAIR_DAY, "sales_qnty", "rest_qnty", "regular_price",
        F.when(is_txn_disc == 1, F.col("regular_price")).otherwise(paid).alias("target_price"),
        F.col("disc_ma_qnty").alias("discount_sum"),
        F.when(F.col("reason_type_id") == predicates.MONITOR_REASON, 1).otherwise(0).alias("is_monitor"),
        F.when(reason == predicates.REGULAR_REASON, 1).otherwise(0).alias("is_regular"),
        sale_reason(
            F.col("reason_type_id"), F.col("factual_price"), F.col("regular_price"), s.promo_discount
        ).alias("sale_reason_type"),
    )


def daily_frame(inputs: Inputs, sales: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """Days of the eligible pairs, whose ``sales`` have their reasons, with factors."""
    rows = (
        sales.join(pairs, PAIR)
        .join(inputs.article_info, "art_id", "left")
        .where(
            ((F.col("rest_qnty") > 0) & (F.coalesce("is_sp_gm", F.lit(0)) == 0))
            | (F.coalesce("sales_qnty", F.lit(0)) > 0)
        )
        .drop("rest_qnty", "is_sp_gm")
    )
    return with_factors(rows, inputs.holidays, inputs.seasons, s)


def day_measures() -> dict[str, Column]:
    """Days and mean sales by kind of day, as aggregates."""
    kind, quantity = F.col("sale_reason_type"), F.col("sales_qnty")
    return {
        "days_cnt_all": F.count("*"),
        "days_cnt_reg": F.count(F.when(kind == 0, 1)),
        "sale_qnty_avg_reg": F.avg(F.when(kind == 0, quantity)),
        "days_cnt_promo": F.count(F.when(kind == 1, 1)),
        "sale_qnty_avg_promo": F.avg(F.when(kind == 1, quantity)),
    }


def with_training_days(measured: DataFrame, min_promo_days: int) -> DataFrame:
    """Whether promo days alone are used, and the number of days that are."""
    promo_only = F.coalesce(
        (F.col("days_cnt_promo") >= min_promo_days)
        & (F.col("days_cnt_reg") >= min_promo_days)
        & (F.col("sale_qnty_avg_promo") >= F.col("sale_qnty_avg_reg")),
        F.lit(False),
    )
    days = F.when(promo_only, F.col("days_cnt_promo")).otherwise(F.col("days_cnt_all"))
    return measured.withColumns({"days_cnt": days, "to_use_only_promo": promo_only.cast("int")})


def pair_summary(rows: DataFrame, min_promo_days: int = 7) -> DataFrame:
    """The summary as one row per pair."""
    measured = rows.groupBy(*PAIR).agg(*[measure.alias(name) for name, measure in day_measures().items()])
    return with_training_days(measured, min_promo_days)


def training_days(rows: DataFrame, s: Settings) -> DataFrame:
    """Delete pairs with too few days and, where promo days alone are used, the other days.

    The window is safe: a pair has one row per day, so at most ``s.days`` rows. It spares a
    second run over the daily frame.
    """
    pair = Window.partitionBy(*PAIR)
    measured = rows.withColumns({name: measure.over(pair) for name, measure in day_measures().items()})
    marked = with_training_days(measured, s.min_promo_days).drop(*day_measures())
    promo_only = F.col("to_use_only_promo") == 1
    needed = F.when(promo_only, s.min_promo_days).otherwise(s.min_days)
    return delete_where(
        marked, (F.col("days_cnt") < needed) | (promo_only & (F.col("sale_reason_type") != 1))
    )


def deflated_sales(rows: DataFrame) -> DataFrame:
    """Sales without season and holiday."""
    one = F.lit(1.0)
    clean = F.try_divide(F.col("sales_qnty"), F.coalesce("coef_holiday", one))
    return rows.withColumn("sale_qnty_clean", F.try_divide(clean, F.coalesce("coef_season", one)))


def day_discount(target: Column, regular: Column, discount_from: str) -> Column:
    if discount_from == "reciprocal":
        depth = F.try_divide(F.try_divide(F.lit(1.0), target), regular)
    else:
        depth = 1 - F.try_divide(target, regular)
    return F.when(depth > 0, depth).otherwise(0.0)


def regular_quantity(rows: DataFrame, discount_from: str = "share") -> DataFrame:
    """Growth of the day's discount and the sales without it."""
    discounted = rows.withColumn(
        "disc_calc", day_discount(F.col("target_price"), F.col("regular_price"), discount_from)
    )
    grown = numeric.with_growth_coefficient(discounted, "coef_growth", "exp_trend_a", "exp_trend_b", "disc_calc")
    base = F.try_divide(numeric.positive_part(F.col("sale_qnty_clean")), F.col("coef_growth"))
    return grown.withColumn("qnty_reg", base)


def baseline_rollup(rows: DataFrame) -> DataFrame:
    """Totals of a pair's days whose quantity is known and not negative.

    The aggregates choose the days: a filter would be pushed below the steps that make the quantity
    and repeat them all as one expression.
    """

    def chosen(value: Column) -> Column:
        return F.when(F.col("qnty_reg") >= 0, value)

    totals = (
        rows.groupBy(*PAIR)
        .agg(
            F.avg(chosen(F.col("regular_price"))).alias("regular_price"),
            F.min(F.lit(0)).alias("regular_price_alg"),
            F.sum(chosen(numeric.positive_part(F.col("sales_qnty")))).alias("sales_qnty"),
            F.sum(chosen(numeric.positive_part(F.col("sale_qnty_clean")))).alias("sale_qnty_clean"),
            F.sum(chosen(F.col("qnty_reg"))).alias("qnty_reg"),
            F.count(chosen(F.lit(1))).alias("days_cnt"),
        )
        .withColumn("sale_qnty_reg_avg", F.try_divide("qnty_reg", "days_cnt"))
    )
    return totals.where((F.col("sale_qnty_reg_avg") > 0) & (F.col("regular_price") > 0))


def training_frame(inputs: Inputs, s: Settings) -> DataFrame:
    """Cleaned training days of all eligible pairs.

    The sales of the window are written once: the choice of pairs and the frame read them. They meet
    promotions and prices by the same keys; then they move once, with the columns that are still needed,
    to buckets of their pair, by which days are counted, pairs met and the window over a pair's days runs.
    """
    promo = promo_days(inputs.calendar, s)
    sales = sales_in_window(inputs.sales, s).select(*PAIR_DAY, *MEASURES)
    sales = with_reasons(with_prices(on_promo_days(sales, promo, s), inputs.prices, s), inputs.reasons, s)
    parts = windows.ranges_of(sales.sparkSession, inputs.sales.count())
    sales = materialise_buckets(sales.repartition(parts, *PAIR), PAIR, parts, "window-sales")
    pairs = with_elasticity(eligible_pairs(inputs, sales, s), inputs.elasticity)
    return deflated_sales(training_days(daily_frame(inputs, sales, pairs, s), s))


def baseline_sales(inputs: Inputs, s: Settings) -> DataFrame:
    return baseline_rollup(regular_quantity(training_frame(inputs, s), s.discount_from))
