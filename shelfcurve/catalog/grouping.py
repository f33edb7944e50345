"""Aggregations, levels, trimming, fit, pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shelfcurve.catalog.entities_sql import with_entities
from shelfcurve.catalog.registry import four_digits, four_digits_sql, query
from shelfcurve.functions import dates
from shelfcurve.operators import aggregates, levels, reshape
from shelfcurve.operators.trim import sigma_trim as trim_by_sigma
from shelfcurve.plans import baseline, elasticity
from shelfcurve.session import materialise
from shelfcurve.sources import retail
from shelfcurve.sources.retail import table

METRICS = [f"prir_{m}" for m in elasticity.METRICS]
BIN_KEYS = ["grp_art_id", "skidgr"]


def growth(spark, sf):
    """Growth of all valid pairs, promotions included. The dimensions are stored, so that the planner sees
    their own size, not that of the tables they are taken from."""
    groups = materialise(elasticity.article_groups(retail.articles(spark, sf)), "groups", plain=True)
    shops = materialise(retail.warehouses(spark, sf), "warehouses", plain=True)
    pairs = elasticity.valid_pairs(retail.price_pairs(spark, sf))
    return elasticity.growth_measures(pairs, groups, shops)


def rounded(df, columns):
    return df.withColumns({c: F.round(c, 4) for c in columns})


GROUP_STATS = ", ".join(
    f"round(avg({m}), 4) AS avg_{m}, round(stddev_pop({m}), 4) AS std_{m}" for m in METRICS
)


@query(with_entities("growth", f"SELECT grp_art_id, skidgr, {GROUP_STATS} FROM growth GROUP BY ALL"))
def group_mean_stddev(spark, sf):
    stats = aggregates.mean_and_spread(growth(spark, sf), BIN_KEYS, METRICS)
    return rounded(stats, stats.columns[2:])


PROFILE = ", ".join(
    f"round(avg(CASE WHEN {f} THEN disc END), 4) AS av_disc_{m}, "
    f"round(stddev_pop(CASE WHEN {f} THEN {m} END), 4) AS std_{m}, "
    f"count(CASE WHEN {f} THEN 1 END) AS cnt_{m}, round(avg(CASE WHEN {f} THEN {m} END), 4) AS avg_{m}"
    for m, f in ((m, f"({m} BETWEEN -0.5 AND 4)") for m in METRICS)
)


@query(with_entities("growth", f"SELECT grp_art_id, skidgr, {PROFILE} FROM growth GROUP BY ALL"))
def discount_bin_profile(spark, sf):
    flags = {m: F.col(m).between(-0.5, 4) for m in METRICS}
    profile = aggregates.flagged_profile(growth(spark, sf), BIN_KEYS, "disc", flags)
    return rounded(profile, [c for c in profile.columns[2:] if not c.startswith("cnt_")])


@query("""
SELECT l_suppkey, p_type, count(DISTINCT CAST(l_shipdate AS DATE)) AS days FROM lineitem
JOIN part ON l_partkey = p_partkey GROUP BY ALL HAVING count(DISTINCT CAST(l_shipdate AS DATE)) >= 14""")
def active_days_min(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sold = table(spark, sf, "lineitem").join(part, "l_partkey")
    sold = sold.withColumn("day", F.col("l_shipdate").cast("date"))
    return aggregates.active_days(sold, ["l_suppkey", "p_type"], "day", 14)


@query(with_entities("daily reasons", """
WITH rows AS (SELECT whs_id, art_id, sales_qnty, CASE
    WHEN coalesce(reason_type_id, 24185) IN (24062, 21001) AND 1 - sale / gross < 0.05 THEN 1
    WHEN coalesce(reason_type_id, 24185) = 24185 AND 1 - sale / gross >= 0.05 THEN 0 ELSE 2 END AS k
  FROM daily LEFT JOIN reasons USING (action_type_id)),
s AS (SELECT whs_id, art_id, count(*) AS days_cnt_all, count(CASE WHEN k = 0 THEN 1 END) AS days_cnt_reg,
  avg(CASE WHEN k = 0 THEN sales_qnty END) AS a, count(CASE WHEN k = 1 THEN 1 END) AS days_cnt_promo,
  avg(CASE WHEN k = 1 THEN sales_qnty END) AS b FROM rows GROUP BY ALL)
SELECT whs_id, art_id, days_cnt_all, days_cnt_reg, round(a, 4) AS sale_qnty_avg_reg, days_cnt_promo,
  round(b, 4) AS sale_qnty_avg_promo,
  CASE WHEN days_cnt_promo >= 1 AND days_cnt_reg >= 1 AND b >= a THEN days_cnt_promo ELSE days_cnt_all END AS days_cnt,
  CASE WHEN days_cnt_promo >= 1 AND days_cnt_reg >= 1 AND b >= a THEN 1 ELSE 0 END AS to_use_only_promo FROM s"""))
def conditional_summary(spark, sf):
    reasons = retail.reasons_of_actions(spark, sf)
    kind = baseline.sale_reason(F.col("reason_type_id"), F.col("sale"), F.col("gross"), 0.05)
    rows = retail.daily_sales(spark, sf).join(reasons, "action_type_id", "left").withColumn("sale_reason_type", kind)
    summary = baseline.pair_summary(rows, min_promo_days=1)
    return rounded(summary, ["sale_qnty_avg_reg", "sale_qnty_avg_promo"])


@query(with_entities("holidays", """
SELECT frmt_id, branch_id, cluster_id, art_grp_lvl_3_id, day_id, round(exp(sum(koeff_holiday)), 4) AS coef_holiday
FROM holidays GROUP BY ALL"""))
def holiday_factor(spark, sf):
    return rounded(baseline.holiday_factors(retail.holiday_coefficients(spark, sf)), ["coef_holiday"])


@query(with_entities("seasons days", """
WITH factors AS (SELECT frmt_id, branch_id, cluster_id, art_grp_lvl_3_id, day_id, avg(greatest(exp(koef_yearly), 0.5)) AS coef_season
FROM seasons JOIN days ON yearday_id = month(day_id) * 100 + day(day_id) GROUP BY ALL)
SELECT frmt_id, branch_id, cluster_id, art_grp_lvl_3_id, count(*) AS days, round(sum(coef_season), 4) AS total,
  round(min(coef_season), 4) AS lowest, round(max(coef_season), 4) AS highest FROM factors GROUP BY ALL"""))
def seasonality_factor(spark, sf):
    factors = baseline.season_factors(retail.season_coefficients(spark, sf))
    days = retail.calendar(spark, sf).select(dates.year_day(F.col("day_id")).alias("yearday_id"))
    daily = factors.join(days, "yearday_id")
    return daily.groupBy(*baseline.FACTOR_GROUP).agg(
        F.count("*").alias("days"), F.round(F.sum("coef_season"), 4).alias("total"),
        F.round(F.min("coef_season"), 4).alias("lowest"), F.round(F.max("coef_season"), 4).alias("highest"),
    )


@query(with_entities("growth", """
SELECT CASE WHEN m & 1 <> 0 THEN gs_fo_id ELSE -1 END AS gs_fo_id, CASE WHEN m & 2 <> 0 THEN frmt_id ELSE -1 END AS frmt_id,
  CAST(m AS INT) AS level_mask, count(*) AS n, round(avg(prir_sale), 4) AS mean_growth
FROM growth, range(4) r(m) GROUP BY ALL"""))
def masked_levels(spark, sf):
    """Sums per region and format first; the copies are made of those, not of rows."""
    sums = growth(spark, sf).groupBy("gs_fo_id", "frmt_id").agg(
        F.count("*").alias("n"), F.sum("prir_sale").alias("s"), F.count("prir_sale").alias("known")
    )
    copies = levels.masked_levels(sums, {"gs_fo_id": F.lit(-1), "frmt_id": F.lit(-1)})
    return copies.groupBy("gs_fo_id", "frmt_id", "level_mask").agg(
        F.sum("n").alias("n"), F.round(F.try_divide(F.sum("s"), F.sum("known")), 4).alias("mean_growth")
    )


@query("""
SELECT s_nationkey, l_returnflag, count(*) AS n, round(sum(l_quantity), 4) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY GROUPING SETS ((s_nationkey, l_returnflag), (s_nationkey), (l_returnflag), ())""")
def grouping_sets_plain(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    nation, flag = F.col("s_nationkey"), F.col("l_returnflag")
    grouped = rows.groupingSets([(nation, flag), (nation,), (flag,), ()], nation, flag)
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))


def trim_sql(source: str, keys: list[str], values: list[str], sigmas=(3.0, 2.5, 2.0, 2.0), prefix: str = "") -> str:
    """Common table expressions that flag the rows of ``source`` pass by pass."""
    key_list, passes = ", ".join(keys), []
    match = " AND ".join(f"r.{k} = b.{k}" for k in keys)
    current = f"(SELECT *, {', '.join(f'({v} IS NOT NULL) AS flag_{v}' for v in values)} FROM {source})"
    for number, width in enumerate(sigmas, 1):
        stats = ", ".join(
            f"avg(CASE WHEN flag_{v} THEN {v} END) AS m_{v}, stddev_pop(CASE WHEN flag_{v} THEN {v} END) AS s_{v}"
            for v in values
        )
        flags = ", ".join(
            f"coalesce(r.{v} BETWEEN round(m_{v} - {width} * s_{v}, 6) AND round(m_{v} + {width} * s_{v}, 6), false) AS flag_{v}"
            for v in values
        )
        plain = f"r.* EXCLUDE ({', '.join(f'flag_{v}' for v in values)})"
        passes.append(f"{prefix}stats{number} AS MATERIALIZED (SELECT {key_list}, {stats} FROM {current} GROUP BY ALL)")
        passes.append(
            f"{prefix}pass{number} AS MATERIALIZED (SELECT {plain}, {flags} FROM {current} r JOIN {prefix}stats{number} b ON {match})"
        )
        current = f"{prefix}pass{number}"
    return ",\n".join(passes)


@query(with_entities("growth", f"""
WITH {trim_sql('growth', BIN_KEYS, METRICS)}
SELECT grp_art_id, skidgr, count(*) AS n, {', '.join(f"count(CASE WHEN flag_{m} THEN 1 END) AS kept_{m}" for m in METRICS)}
FROM pass4 GROUP BY ALL"""))
def sigma_trim(spark, sf):
    rows = materialise(growth(spark, sf), "growth")
    flagged = trim_by_sigma(rows, BIN_KEYS, METRICS)
    kept = [F.sum(f"flag_{m}").alias(f"kept_{m}") for m in METRICS]
    return flagged.groupBy(*BIN_KEYS).agg(F.count("*").alias("n"), *kept)


def growth_groups(spark, sf):
    return growth(spark, sf).groupBy(*BIN_KEYS).agg(
        F.avg("disc").cast("double").alias("av_disc"), F.avg("prir_sale").alias("prir"),
        F.stddev_pop("prir_sale").alias("stddev_koeff"), F.count("*").alias("cnt_int_rows"),
    )


GROUPS_SQL = (
    "groups AS MATERIALIZED (SELECT grp_art_id, skidgr, avg(disc) AS av_disc, avg(prir_sale) AS prir, "
    "stddev_pop(prir_sale) AS stddev_koeff, count(*) AS cnt_int_rows FROM growth GROUP BY ALL)"
)


@query(with_entities("growth", f"""
WITH {GROUPS_SQL}
SELECT grp_art_id, skidgr, round(prir, 4) AS prir, cnt_int_rows FROM groups
WHERE (round(stddev_koeff / (prir + 1), 6) < 0.9 OR cnt_int_rows >= 200) AND cnt_int_rows >= 10"""))
def group_quality_gate(spark, sf):
    groups = growth_groups(spark, sf)
    good = aggregates.quality_gate(groups, "stddev_koeff", "prir", "cnt_int_rows", max_spread=0.9)
    return good.select(*BIN_KEYS, F.round("prir", 4).alias("prir"), "cnt_int_rows")


@query(with_entities("growth", f"""
WITH {GROUPS_SQL},
weighted AS (SELECT *, skidgr / 1000.0::DOUBLE AS x, ln(prir + 1) AS y, CASE WHEN max(cnt_int_rows) OVER (PARTITION BY grp_art_id) >= 15
    THEN least(1.0::DOUBLE, cnt_int_rows / 15000.0::DOUBLE)
    ELSE cnt_int_rows / least(max(cnt_int_rows) OVER (PARTITION BY grp_art_id)::DOUBLE, 15000.0::DOUBLE) END AS w FROM groups),
sums AS (SELECT grp_art_id, count(*) AS disc_group_cnt, min(av_disc) AS min_discount, max(av_disc) AS max_discount,
  avg(stddev_koeff) AS avg_stddev, max(stddev_koeff) AS max_stddev, CAST(sum(cnt_int_rows) AS BIGINT) AS sum_cnt_int_rows,
  min(cnt_int_rows) AS min_cnt_int_rows, sum(w) AS sw, sum(w * x) AS swx, sum(w * x * x) AS swxx, sum(w * y) AS swy,
  sum(w * x * y) AS swxy FROM weighted GROUP BY ALL),
fit AS (SELECT *, -(swxy * sw - swy * swx) / nullif(swxx * sw - swx * swx, 0) AS b FROM sums)
SELECT grp_art_id, disc_group_cnt, round(min_discount, 4) AS min_discount, round(max_discount, 4) AS max_discount,
  round(avg_stddev, 4) AS avg_stddev, round(max_stddev, 4) AS max_stddev, sum_cnt_int_rows, min_cnt_int_rows,
  round(b, 4) AS exp_trend_b, round((b * swx + swy) / sw, 4) AS exp_trend_a FROM fit"""))
def weighted_log_fit(spark, sf):
    points, x = growth_groups(spark, sf), F.col("skidgr") / 1000.0
    fit = aggregates.weighted_log_fit(points, ["grp_art_id"], x, F.col("prir"), F.col("cnt_int_rows"))
    return rounded(
        fit, ["min_discount", "max_discount", "avg_stddev", "max_stddev", "exp_trend_a", "exp_trend_b"]
    )


@query(with_entities("observations warehouses clusters", """
SELECT whs_id, art_id, max(frmt_id) AS frmt_id, max(branch_id) AS branch_id, max(cluster_id) AS cluster_id
FROM observations JOIN warehouses USING (whs_id) LEFT JOIN clusters USING (whs_id) GROUP BY ALL"""))
def collapse_by_max(spark, sf):
    rows = (
        retail.observations(spark, sf).select("whs_id", "art_id")
        .join(retail.warehouses(spark, sf), "whs_id").join(retail.clusters(spark, sf), "whs_id", "left")
    )
    return aggregates.collapse_by_max(rows, ["whs_id", "art_id"], ["frmt_id", "branch_id", "cluster_id"])


@query(with_entities("daily", f"""
SELECT whs_id, art_id, {four_digits_sql('avg(gross / sales_qnty)')} AS regular_price, 0 AS regular_price_alg,
  round(sum(sales_qnty), 4) AS sales_qnty, round(sum(sale), 4) AS sale_qnty_clean, round(sum(sales_qnty - rest_qnty), 4) AS qnty_reg,
  count(*) AS days_cnt, round(sum(sales_qnty - rest_qnty) / count(*), 4) AS sale_qnty_reg_avg
FROM daily WHERE sales_qnty - rest_qnty >= 0 GROUP BY ALL HAVING sum(sales_qnty - rest_qnty) / count(*) > 0"""))
def baseline_rollup(spark, sf):
    """The rollup of the baseline job on plain daily sales."""
    days = retail.daily_sales(spark, sf).withColumns(
        {
            "regular_price": F.try_divide("gross", "sales_qnty"),
            "sale_qnty_clean": F.col("sale"),
            "qnty_reg": F.col("sales_qnty") - F.col("rest_qnty"),
        }
    )
    totals = baseline.baseline_rollup(days)
    totals = totals.withColumn("regular_price", four_digits(F.col("regular_price")))
    return rounded(totals, ["sales_qnty", "sale_qnty_clean", "qnty_reg", "sale_qnty_reg_avg"])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def daily_maxima(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type", F.col("value"))


PIVOT_SQL = "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' THEN value END) AS \"{e}\"" for e in EVENT_TYPES
) + " FROM events GROUP BY ALL"


@query(PIVOT_SQL)
def pivot_max(spark, sf):
    return reshape.pivot_max(daily_maxima(spark, sf), ["user_id"], "event_type", "value", EVENT_TYPES)


@query(PIVOT_SQL)
def pivot_case(spark, sf):
    names = {e: e for e in EVENT_TYPES}
    return reshape.pivot_case(daily_maxima(spark, sf), ["user_id"], "event_type", "value", names)


@query("SELECT user_id, event_type, max(value) AS value FROM events GROUP BY ALL HAVING max(value) IS NOT NULL")
def unpivot_days(spark, sf):
    wide = reshape.pivot_max(daily_maxima(spark, sf), ["user_id"], "event_type", "value", EVENT_TYPES)
    return reshape.unpivot(wide, ["user_id"], EVENT_TYPES, "event_type", "value")


@query("""
SELECT 'customer' AS table_name, DATE '2024-01-01' AS taken_at, count(*) AS row_count,
  round(avg(20 + strlen(c_name) + strlen(c_mktsegment)), 4) AS avg_row_size FROM customer
UNION ALL SELECT 'lineitem', DATE '2024-01-01', count(*), round(avg(68 + strlen(l_returnflag) + strlen(l_linestatus)), 4) FROM lineitem
UNION ALL SELECT 'documents', DATE '2024-01-01', count(*), round(avg(16 + strlen(text) + strlen(lang) + strlen(source)), 4) FROM documents""")
def table_profile(spark, sf):
    taken = F.lit("2024-01-01").cast("date")
    profiles = [
        aggregates.table_profile(table(spark, sf, name), name, taken) for name in ("customer", "lineitem", "documents")
    ]
    return rounded(reduce(lambda a, b: a.unionByName(b), profiles), ["avg_row_size"])


@query("""
SELECT l_suppkey, coalesce(arg_min(l_extendedprice, (abs(l_extendedprice - 50000), -l_orderkey, -l_linenumber, -l_partkey))
  FILTER (abs(l_extendedprice - 50000) <= 300), -1) AS nearest FROM lineitem GROUP BY ALL""")
def nearest_value(spark, sf):
    return aggregates.nearest_value(
        table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", 50000.0,
        ["l_orderkey", "l_linenumber", "l_partkey"], 300.0, F.lit(-1.0),
    )
