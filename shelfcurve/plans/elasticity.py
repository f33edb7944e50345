"""From price changes to elasticities.

A price change is a pair of periods of one article in one warehouse. Pairs under promotion
are left out, the rest is grouped by depth of discount at several rollup levels, trimmed,
and fitted: ln(growth + 1) = a + b * discount. Each article then gets the trend of its
deepest group that has one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from shelfcurve.functions import numeric, predicates, text
from shelfcurve.operators import aggregates, joins, levels, trim, windows
from shelfcurve.operators.trim import SIGMAS
from shelfcurve.session import materialise, store

METRICS = ("sale", "client", "txn", "ssn")
ALL = "-1"
# Measures that must be above zero.
POSITIVE = (
    "scnd_sale_qnty", "scnd_client_cnt", "scnd_txn_cnt", "scnd_price", "frst_sale_qnty",
    "frst_client_cnt", "frst_txn_cnt", "frst_price", "scnd_day_cnt_rest_sales",
)
SIDES = ("frst", "scnd")
PERIOD_DATES = ("frst_begin_dt", "frst_end_dt", "scnd_begin_dt", "scnd_end_dt")
GROUP = ["grp_art_id", "brand", "gs_fo_id", "frmt_id", "algorithm_type"]
FIXED_LEVELS = ["aum_type_id", "scnd_holiday_id", "direction_type"]
LEVEL = ["level_mask", "all_brands"]


@dataclass(frozen=True)
class Settings:
    """Defaults are those of the yearly run: fixed values."""

    blackouts: tuple = predicates.BLACKOUTS
    horizon_days: int = 365 * 3 + 1
    statuses: tuple = (411, 421, 700, 701, 702, 710, 711)
    campaign_name: str = "дмп"
    companies: tuple = (1, 21)
    campaign_share: float = 0.7
    calendar_share: float = 0.3
    sigmas: tuple = SIGMAS
    metrics: tuple = ("sale",)
    max_spread: float = 0.5
    loose_points: int = 200
    min_points: int = 10
    spread_digits: int = 6
    more_bins_than: int = 3
    span_over: int = 200
    max_points: float = 15000.0
    sample_discount: float = 0.2
    wo_dmp: int = 1


@dataclass(frozen=True)
class Promotions:
    """Campaign headers, their warehouses and actions, and the promo calendar."""

    headers: DataFrame
    warehouses: DataFrame
    actions: DataFrame
    calendar: DataFrame
    header_order: tuple = ("load_dtm",)


def article_groups(articles: DataFrame, level: int = 3, any_brand: bool = False) -> DataFrame:
    """Article with its group at a level, direction type and brand."""
    brand = F.lit(ALL) if any_brand else text.normalise_brand(F.col("art_grp_2_lvl_1_name"))
    direction = F.when(F.col("direction").isin(3, 4), 34).otherwise(12)
    return articles.select(
        "art_id",
        F.col(f"art_grp_lvl_{level}_id").alias("grp_art_id"),
        direction.alias("direction_type"),
        brand.alias("brand"),
    ).distinct()


def remap_regions(warehouses: DataFrame, mapping: dict = predicates.REGION_REMAP) -> DataFrame:
    return warehouses.withColumn("gs_fo_id", predicates.remap(F.col("gs_fo_id"), mapping))


def valid_pairs(pairs: DataFrame, blackouts=predicates.BLACKOUTS) -> DataFrame:
    """Pairs with positive measures, no price increase, and no date in a blackout."""
    change = F.try_divide(F.col("scnd_price").cast("double"), F.col("frst_price").cast("double")) - 1
    return pairs.where(
        predicates.all_positive(*POSITIVE)
        & (change <= 0)
        & predicates.outside_periods(PERIOD_DATES, blackouts)
    )


def known_pairs(pairs: DataFrame, groups: DataFrame, s: Settings) -> DataFrame:
    """Valid pairs of the articles in ``groups``."""
    return valid_pairs(pairs, s.blackouts).join(groups.select("art_id").distinct(), "art_id", "left_semi")


def horizon(pairs: DataFrame, s: Settings) -> Column:
    """First day that counts: a fixed number of days before the latest period, as a subquery."""
    return pairs.agg(F.date_sub(F.max("scnd_begin_dt"), s.horizon_days)).scalar()


def campaign_intervals(promotions: Promotions, since: Column, s: Settings) -> DataFrame:
    """Periods of matching campaigns per warehouse and article; the latest header counts."""
    current = F.col("status_id").isin(*s.statuses) & (F.col("end_dt") >= since)
    headers = windows.first_per_key(
        promotions.headers.where(current),
        ["mc_id"],
        [F.col(c).desc() for c in promotions.header_order],
    )
    named = promotions.actions.where(text.contains_ignoring_case(F.col("name"), s.campaign_name))
    return (
        headers.join(promotions.warehouses.select("mc_id", "whs_id"), "mc_id")
        .join(named.select("action_id").distinct(), "action_id", "left_semi")
        .select("whs_id", "art_id", F.col("begin_dt").alias("beg_dt"), "end_dt")
    )


def calendar_intervals(promotions: Promotions, since: Column, s: Settings) -> DataFrame:
    current = F.col("market_company_id").isin(*s.companies) & (F.col("end_dt") >= since)
    listed = promotions.calendar.where(current)
    return listed.select("whs_id", "art_id", "beg_dt", "end_dt")


def promoted_periods(pairs: DataFrame, promotions: Promotions, since: Column, s: Settings) -> DataFrame:
    """Period begins under promotion: ``side`` tells whether of the first or the second period.

    A campaign excludes pairs of the same algorithm only, the calendar excludes all: there
    the algorithm is NULL. Both periods of a pair go through one join with the promotions.
    """
    keys, event, promo = ["whs_id", "art_id"], ("begin_dt", "end_dt"), ("beg_dt", "end_dt")
    both = F.array(
        *[
            F.struct(F.lit(side).alias("side"), F.col(f"{side}_begin_dt").alias("begin_dt"), F.col(f"{side}_end_dt").alias("end_dt"))
            for side in SIDES
        ]
    )
    periods = pairs.select(*keys, "algorithm_type", F.inline(both))
    campaigns = joins.overlapped(
        periods, campaign_intervals(promotions, since, s), keys, event, promo, s.campaign_share,
        ["side", "algorithm_type"],
    )
    calendar = joins.overlapped(
        periods, calendar_intervals(promotions, since, s), keys, event, promo, s.calendar_share, ["side"]
    )
    found = campaigns.drop("end_dt").unionByName(calendar.drop("end_dt"), allowMissingColumns=True)
    return found.distinct()


def without_promoted(pairs: DataFrame, promoted: DataFrame) -> DataFrame:
    """One anti-join per period instead of one per period and kind of promotion."""
    kept = pairs
    for side in SIDES:
        p = promoted.where(F.col("side") == side).select(
            F.col("whs_id").alias("p_whs"), F.col("art_id").alias("p_art"),
            F.col("begin_dt").alias("p_begin"), F.col("algorithm_type").alias("p_algorithm"),
        )
        same = (F.col("whs_id") == F.col("p_whs")) & (F.col("art_id") == F.col("p_art"))
        covers = F.col("p_algorithm").isNull() | (F.col("p_algorithm") == F.col("algorithm_type"))
        kept = kept.join(p, same & (F.col(f"{side}_begin_dt") == F.col("p_begin")) & covers, "left_anti")
    return kept


def growth_columns() -> dict[str, Column]:
    q1, q2 = F.col("frst_sale_qnty"), F.col("scnd_sale_qnty")

    def by(base: str) -> Column:
        return numeric.growth(q1, q2, F.col(f"frst_{base}"), F.col(f"scnd_{base}"))

    return {
        "prir_sale": by("day_cnt_rest_sales"),
        "prir_client": by("client_cnt"),
        "prir_txn": by("txn_cnt"),
        "prir_ssn": numeric.seasonal_growth(q1, q2, F.col("ssn_coef_sale_txn")),
    }


def growth_measures(pairs: DataFrame, groups: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Discount, bin and growth of each pair; pairs whose sales fell are left out."""
    rows = pairs.join(groups, "art_id").join(warehouses.select("whs_id", "gs_fo_id", "frmt_id"), "whs_id")
    reason = predicates.classify(F.col("scnd_reason_type_id"), predicates.REASON_TYPES, predicates.OTHER_REASON)
    measured = rows.withColumns(
        {
            "aum_type_id": reason,
            "scnd_holiday_id": F.coalesce("scnd_holiday_id", F.lit(0)),
            "disc": numeric.discount(F.col("frst_price"), F.col("scnd_price")),
            **growth_columns(),
        }
    )
    return measured.where(F.col("prir_sale") >= 0).select(
        "whs_id", "art_id", "grp_art_id", "brand", "gs_fo_id", "frmt_id", "algorithm_type",
        "aum_type_id", "scnd_holiday_id", "direction_type", "disc",
        numeric.discount_bin(F.col("disc")).alias("skidgr"),
        "prir_sale", "prir_client", "prir_txn", "prir_ssn",
    )


def rollup(rows: DataFrame, brands: bool = True) -> DataFrame:
    """Rows at every level of region and format, for all brands and for each brand."""
    copies = levels.masked_levels(rows, {"gs_fo_id": F.lit(-1), "frmt_id": F.lit(-1)})
    options = F.array(F.lit(True), F.lit(False)) if brands else F.array(F.lit(True))
    copies = copies.withColumn("all_brands", F.explode(options))
    return copies.withColumn("brand", F.when(F.col("all_brands"), ALL).otherwise(F.col("brand")))


def trimmed_profile(rows: DataFrame, s: Settings, brands: bool = True) -> DataFrame:
    """Each discount bin of each group at every level, trimmed: one row per metric.

    The rows are read once, into blocks per finest key; levels and passes work on those.
    """
    blocks = trim.value_blocks(rows, [*GROUP, "skidgr"], [f"prir_{m}" for m in s.metrics], F.col("disc"))
    levels_ = trim.levels_of(blocks, [*GROUP, *LEVEL, "skidgr"], lambda df: rollup(df, brands))
    left = trim.band_stats(levels_, trim.trim_bands(levels_, s.sigmas))
    number = F.array_position(F.array(*[F.lit(f"prir_{m}") for m in METRICS]), F.col("_metric")).cast("int")
    return left.select("_group_key.*", "n", "mean", "sd", "carried").select(
        *GROUP, *LEVEL, "skidgr", number.alias("type_prirost"), F.col("carried").alias("av_disc"),
        F.col("mean").alias("prir"), F.col("sd").alias("stddev_koeff"), F.col("n").alias("cnt_int_rows"),
    )


def trend_points(points: DataFrame, keys: list[str], s: Settings) -> DataFrame:
    """Bins good enough for a fit, of groups with enough bins; one row per metric."""
    good = aggregates.quality_gate(
        points, "stddev_koeff", "prir", "cnt_int_rows",
        s.max_spread, s.loose_points, s.min_points, s.spread_digits,
    )
    wide = windows.span_filter(good, [*keys, "type_prirost"], "skidgr", s.more_bins_than, s.span_over)
    return wide.withColumn("wo_dmp", F.lit(s.wo_dmp))


def level_points(rows: DataFrame, s: Settings, brands: bool = True) -> DataFrame:
    """Trend points of all rollup levels of growth rows. The profile is stored, because it is read for
    the finished groups and for the fit; rows, blocks and bands are removed with that. The dimensions
    that are rolled up at every level join the key at the end."""
    profile = store(rows.sparkSession, lambda: trimmed_profile(materialise(rows, "growth"), s, brands), "profile")
    return trend_points(profile, [*GROUP, *LEVEL], s).drop(*LEVEL).withColumns({c: F.lit(-1) for c in FIXED_LEVELS})


def fit_trends(points: DataFrame, group_levels: DataFrame, max_points: float = 15000.0) -> DataFrame:
    """One trend per group and metric, with the hierarchy level of the group."""
    keys = [*GROUP, *FIXED_LEVELS, "type_prirost", "wo_dmp"]
    depth = F.col("skidgr") / 1000.0
    fitted = aggregates.weighted_log_fit(points, keys, depth, F.col("prir"), F.col("cnt_int_rows"), max_points)
    lvl = group_levels.select("grp_art_id", F.col("lvl").alias("art_grp_lvl"))
    return fitted.join(lvl, "grp_art_id").withColumn("subfrmt_id", F.lit(-1))


def elasticity_trends(
    pairs: DataFrame,
    articles: DataFrame,
    warehouses: DataFrame,
    group_levels: DataFrame,
    promotions: Promotions,
    s: Settings = Settings(),
) -> DataFrame:
    """Trends of all groups: at level 3, then at level 2 for groups without one.

    "Without one" compares level-2 ids with the ids of finished groups, whatever the level
    of those: ids are meant to be unique across levels.
    """
    regions = remap_regions(warehouses)
    fine_groups = article_groups(articles, 3)
    pairs = materialise(known_pairs(pairs, fine_groups, s), "pairs")
    since = horizon(pairs, s)
    recent = pairs.where(F.col("scnd_begin_dt") >= since)
    promoted = materialise(promoted_periods(recent, promotions, since, s), "promoted", plain=True)
    fine = growth_measures(without_promoted(recent, promoted), fine_groups, regions)
    first = level_points(fine, s)

    done = first.where((F.col("brand") == ALL) & (F.col("wo_dmp") == s.wo_dmp)).select("grp_art_id").distinct()
    coarse_groups = article_groups(articles, 2, any_brand=True).join(done, "grp_art_id", "left_anti")
    open_pairs = pairs.join(coarse_groups.select("art_id"), "art_id", "left_semi")
    recent = open_pairs.where(F.col("scnd_begin_dt") >= horizon(open_pairs, s))
    coarse = growth_measures(without_promoted(recent, promoted), coarse_groups, regions)
    second = level_points(coarse, replace(s, spread_digits=3), brands=False)
    return fit_trends(first.unionByName(second), group_levels, s.max_points)


def elasticity_by_article(trends: DataFrame, articles: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The best trend of each article and format: deepest level first, own brand before all."""
    usable = trends.where(
        (F.col("gs_fo_id") == -1)
        & (F.col("algorithm_type") == 1)
        & (F.round("exp_trend_b", 3) >= 0)
        & (F.col("wo_dmp") == s.wo_dmp)
    )
    named = articles.withColumn("check_brand", text.normalise_brand(F.col("art_grp_2_lvl_1_name")))
    matched = joins.match_hierarchy(
        named, usable, "art_id", {n: f"art_grp_lvl_{n}_id" for n in range(4)}, "check_brand"
    )
    order = [-F.col("art_grp_lvl"), (F.col("brand") == ALL).cast("int")]
    best = windows.best_per_key(matched, ["wo_dmp", "art_id", "frmt_id"], order)
    coef = F.exp(F.col("exp_trend_a") + F.col("exp_trend_b") * s.sample_discount)
    return best.select(
        "wo_dmp", "art_id", "frmt_id", "art_grp_lvl", "grp_art_id", "brand",
        F.col("exp_trend_a").cast("float").alias("exp_trend_a"),
        F.col("exp_trend_b").cast("float").alias("exp_trend_b"),
        coef.cast("float").alias("coef"),
        F.lit(None).cast("float").alias("coef_dmp"),
        F.lit(1).alias("num_order"),
    )
