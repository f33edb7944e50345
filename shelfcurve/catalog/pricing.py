"""The elasticity and baseline jobs."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from shelfcurve.catalog.entities_sql import with_entities
from shelfcurve.catalog.grouping import GROUPS_SQL, growth, growth_groups, rounded, trim_sql
from shelfcurve.catalog.registry import four_digits, four_digits_sql, query
from shelfcurve.operators import aggregates
from shelfcurve.operators.windows import ranges_of
from shelfcurve.plans import baseline, elasticity
from shelfcurve.session import materialise, materialise_buckets
from shelfcurve.sources import retail

SETTINGS = elasticity.Settings(statuses=("F",), campaign_name="red", companies=(1,))


def promotions(spark, sf) -> elasticity.Promotions:
    return elasticity.Promotions(
        retail.campaign_headers(spark, sf), retail.campaign_warehouses(spark, sf), retail.campaign_actions(spark, sf),
        retail.promo_calendar(spark, sf), ("load_dtm", "l_linenumber", "action_id", "l_extendedprice"),
    )


def trends(spark, sf, settings=SETTINGS):
    # stored, so that the planner sees their own size, not that of the tables they are taken from
    goods = materialise(retail.articles(spark, sf), "articles", plain=True)
    shops = materialise(retail.warehouses(spark, sf), "warehouses", plain=True)
    return elasticity.elasticity_trends(
        retail.price_pairs(spark, sf), goods, shops, retail.group_levels(goods),
        promotions(spark, sf), settings,
    )


@query(with_entities("growth", """
SELECT whs_id, art_id, grp_art_id, brand, gs_fo_id, frmt_id, aum_type_id, direction_type, skidgr, disc,
  round(prir_sale, 4) AS prir_sale, round(prir_client, 4) AS prir_client, round(prir_txn, 4) AS prir_txn,
  round(prir_ssn, 4) AS prir_ssn FROM growth"""))
def growth_measures(spark, sf):
    rows = growth(spark, sf).withColumn("disc", F.col("disc").cast("double"))
    return rounded(rows.drop("algorithm_type", "scnd_holiday_id"), ["prir_sale", "prir_client", "prir_txn", "prir_ssn"])


def _promoted_sql(side: str) -> str:
    def flagged(source: str, begin: str, share: float, algorithm: str) -> str:
        return f"""SELECT DISTINCT r.whs_id, r.art_id, {side}_begin_dt AS d, {algorithm} AS alg FROM recent r JOIN {source} c
  ON r.whs_id = c.whs_id AND r.art_id = c.art_id AND c.{begin} <= {side}_end_dt AND c.end_dt >= {side}_begin_dt
  WHERE (date_diff('day', greatest(c.{begin}, {side}_begin_dt), least(c.end_dt, {side}_end_dt)) + 1)::DOUBLE
    / (date_diff('day', {side}_begin_dt, {side}_end_dt) + 1) >= {share}"""

    return (
        f"promoted_{side} AS MATERIALIZED ({flagged('campaign_periods', 'begin_dt', 0.7, 'algorithm_type')}\n"
        f"  UNION ALL {flagged('calendar_periods', 'beg_dt', 0.3, 'NULL')})"
    )


def _unpromoted(rows: str) -> str:
    tests = " AND ".join(
        f"""NOT EXISTS (SELECT 1 FROM promoted_{s} p WHERE p.whs_id = g.whs_id AND p.art_id = g.art_id
    AND p.d = g.{s}_begin_dt AND (p.alg IS NULL OR p.alg = g.algorithm_type))"""
        for s in ("scnd", "frst")
    )
    return f"SELECT g.* FROM {rows} g WHERE {tests}"


_LEVEL_KEYS = ["skidgr", "grp_art_id", "brand", "gs_fo_id", "frmt_id", "m", "b"]
_GROUP_KEYS = "grp_art_id, brand, gs_fo_id, frmt_id, m, b"


def _run_sql(prefix: str, rows: str, brands: int, digits: int, metrics: tuple) -> str:
    """Rollup, trimming, profile and gates of one run."""
    profiles = "\n    UNION ALL ".join(
        f"SELECT {', '.join(_LEVEL_KEYS)}, {elasticity.METRICS.index(m) + 1} AS type_prirost, avg(CASE WHEN flag_prir_{m} THEN disc END) AS av_disc, "
        f"avg(CASE WHEN flag_prir_{m} THEN prir_{m} END) AS prir, stddev_pop(CASE WHEN flag_prir_{m} THEN prir_{m} END) AS sd, "
        f"count(CASE WHEN flag_prir_{m} THEN 1 END) AS n FROM {prefix}pass4 GROUP BY ALL"
        for m in metrics
    )
    values = [f"prir_{m}" for m in metrics]
    return f"""{prefix}levels AS MATERIALIZED (SELECT skidgr, grp_art_id, CASE WHEN b = 1 THEN '-1' ELSE brand END AS brand,
    CASE WHEN m & 1 = 0 THEN -1 ELSE gs_fo_id END AS gs_fo_id, CASE WHEN m & 2 = 0 THEN -1 ELSE frmt_id END AS frmt_id,
    m, b, disc, {', '.join(values)} FROM {rows}, range(4) x(m), range({2 - brands}, 2) y(b)),
{trim_sql(prefix + 'levels', _LEVEL_KEYS, values, prefix=prefix)},
{prefix}profile AS MATERIALIZED ({profiles}),
{prefix}points AS MATERIALIZED (SELECT * FROM {prefix}profile
    WHERE (round(sd / (prir + 1), {digits}) < 0.5 OR n >= 200) AND n >= 10
    QUALIFY count(*) OVER (PARTITION BY {_GROUP_KEYS}, type_prirost) > 3
      AND max(skidgr) OVER (PARTITION BY {_GROUP_KEYS}, type_prirost) - min(skidgr) OVER (PARTITION BY {_GROUP_KEYS}, type_prirost) > 200)"""


def _trends_sql(metrics: tuple) -> str:
    return f"""WITH horizon AS (SELECT max(scnd_begin_dt) - 1096 AS d FROM valid_pairs),
recent AS MATERIALIZED (SELECT * FROM valid_pairs WHERE scnd_begin_dt >= (SELECT d FROM horizon)),
headers AS (SELECT * FROM campaigns WHERE status_id = 'F' AND end_dt >= (SELECT d FROM horizon) QUALIFY row_number() OVER (
  PARTITION BY mc_id ORDER BY load_dtm DESC, l_linenumber DESC, action_id DESC, l_extendedprice DESC) = 1),
campaign_periods AS MATERIALIZED (SELECT DISTINCT w.whs_id, art_id, begin_dt, end_dt FROM headers h
  JOIN (SELECT DISTINCT l_orderkey AS mc_id, l_suppkey AS whs_id FROM lineitem WHERE l_discount = 0.1) w USING (mc_id)
  JOIN part ON action_id = p_partkey WHERE lower(p_name) LIKE '%red%'),
calendar_periods AS MATERIALIZED (SELECT DISTINCT whs_id, art_id, beg_dt, end_dt FROM promo_calendar
  WHERE end_dt >= (SELECT d FROM horizon)),
{_promoted_sql('scnd')},
{_promoted_sql('frst')},
fine AS MATERIALIZED ({_unpromoted("(SELECT * FROM growth WHERE scnd_begin_dt >= (SELECT d FROM horizon))")}),
{_run_sql('f', 'fine', 2, 6, metrics)},
open_articles AS (SELECT art_id, art_grp_lvl_2_id AS grp2 FROM articles WHERE art_grp_lvl_2_id NOT IN (
  SELECT grp_art_id FROM fpoints WHERE brand = '-1')),
horizon2 AS (SELECT max(scnd_begin_dt) - 1096 AS d FROM valid_pairs JOIN open_articles USING (art_id)),
coarse AS MATERIALIZED ({_unpromoted('''(SELECT v.* EXCLUDE (grp_art_id), grp2 AS grp_art_id FROM growth v JOIN open_articles USING (art_id)
  WHERE scnd_begin_dt >= (SELECT d FROM horizon2))''')}),
{_run_sql('c', 'coarse', 1, 3, metrics)},
points AS (SELECT * FROM fpoints UNION ALL SELECT * FROM cpoints),
weighted AS (SELECT *, skidgr / 1000.0::DOUBLE AS x, ln(prir + 1) AS y,
  least(1.0::DOUBLE, n / 15000.0::DOUBLE) AS w FROM points),
sums AS (SELECT grp_art_id, brand, gs_fo_id, frmt_id, type_prirost, count(*) AS disc_group_cnt, min(av_disc) AS min_discount,
  max(av_disc) AS max_discount, avg(sd) AS avg_stddev, max(sd) AS max_stddev, CAST(sum(n) AS BIGINT) AS sum_cnt_int_rows,
  min(n) AS min_cnt_int_rows, sum(w) AS sw, sum(w * x) AS swx, sum(w * x * x) AS swxx, sum(w * y) AS swy, sum(w * x * y) AS swxy
  FROM weighted GROUP BY ALL),
slopes AS (SELECT *, -(swxy * sw - swy * swx) / nullif(swxx * sw - swx * swx, 0) AS b FROM sums),
trends AS MATERIALIZED (SELECT lvl AS art_grp_lvl, s.*, b AS exp_trend_b, (b * swx + swy) / sw AS exp_trend_a
  FROM slopes s JOIN group_levels USING (grp_art_id))"""


_TRENDS = _trends_sql(SETTINGS.metrics)
TREND_ENTITIES = "growth campaigns promo_calendar group_levels"

TREND_COLUMNS = [
    "art_grp_lvl", "grp_art_id", "brand", "gs_fo_id", "frmt_id", "disc_group_cnt", "sum_cnt_int_rows", "min_cnt_int_rows",
]
TREND_MEASURES = ["min_discount", "max_discount", "avg_stddev", "max_stddev", "exp_trend_a", "exp_trend_b"]


_TREND_SELECT = f"""
SELECT {', '.join(TREND_COLUMNS)}, {', '.join(f'round({m}, 4) AS {m}' for m in TREND_MEASURES)} FROM trends"""


@query(with_entities(TREND_ENTITIES, _TRENDS + _TREND_SELECT))
def elasticity_trend(spark, sf):
    return rounded(trends(spark, sf).select(*TREND_COLUMNS, *TREND_MEASURES), TREND_MEASURES)


@query(with_entities(TREND_ENTITIES, _trends_sql(elasticity.METRICS) + _TREND_SELECT.replace("SELECT", "SELECT type_prirost,")))
def elasticity_trend_all_metrics(spark, sf):
    """Trends of the growth of sales, per client, per receipt, and freed of the season."""
    found = trends(spark, sf, replace(SETTINGS, metrics=elasticity.METRICS))
    return rounded(found.select("type_prirost", *TREND_COLUMNS, *TREND_MEASURES), TREND_MEASURES)


_BY_ARTICLE = _TRENDS + """,
by_article AS MATERIALIZED (SELECT 1 AS wo_dmp, art_id, frmt_id, art_grp_lvl, grp_art_id, brand, CAST(exp_trend_a AS FLOAT) AS exp_trend_a,
  CAST(exp_trend_b AS FLOAT) AS exp_trend_b, CAST(exp(exp_trend_a + exp_trend_b * 0.2) AS FLOAT) AS coef
FROM articles a JOIN trends t ON ((grp_art_id = art_grp_lvl_3_id AND art_grp_lvl = 3) OR (grp_art_id = art_grp_lvl_2_id AND art_grp_lvl = 2)
  OR (grp_art_id = art_grp_lvl_1_id AND art_grp_lvl = 1) OR (grp_art_id = art_grp_lvl_0_id AND art_grp_lvl = 0))
  AND (brand = lower(art_grp_2_lvl_1_name) OR brand = '-1')
WHERE gs_fo_id = -1 AND round(exp_trend_b, 3) >= 0
QUALIFY rank() OVER (PARTITION BY art_id, frmt_id ORDER BY art_grp_lvl DESC, CASE WHEN brand = '-1' THEN 1 ELSE 0 END) = 1)"""


@query(with_entities(TREND_ENTITIES, _BY_ARTICLE + """
SELECT wo_dmp, art_id, frmt_id, art_grp_lvl, grp_art_id, brand, round(CAST(exp_trend_a AS DOUBLE), 3) AS exp_trend_a,
  round(CAST(exp_trend_b AS DOUBLE), 3) AS exp_trend_b, round(CAST(coef AS DOUBLE), 3) AS coef, CAST(NULL AS FLOAT) AS coef_dmp,
  1 AS num_order FROM by_article"""))
def elasticity_by_article(spark, sf):
    best = elasticity.elasticity_by_article(trends(spark, sf), retail.articles(spark, sf), SETTINGS)
    return best.withColumns(
        {c: F.round(F.col(c).cast("double"), 3) for c in ("exp_trend_a", "exp_trend_b", "coef")}
    )


# The test tables hold few sales per warehouse and article, so the window is long.
DAYS, MIN_DAYS, MIN_PROMO_DAYS = 1500, 2, 1


def baseline_inputs(spark, sf, article_trends) -> tuple[baseline.Inputs, baseline.Settings]:
    # the job expects its inputs as stored tables: sales and prices in buckets of the keys they meet by,
    # dimensions at their own size, not that of the tables they are taken from
    parts, small = ranges_of(spark, retail.table(spark, sf, "lineitem").count()), partial(materialise, plain=True)
    daily = materialise_buckets(retail.daily_sales(spark, sf, parts), baseline.PAIR_DAY, parts, "daily")
    goods = small(retail.articles(spark, sf), "articles")
    sold = retail.table(spark, sf, "lineitem")
    today = sold.agg(F.date_add(F.max(F.col("l_shipdate").cast("date")), 1)).scalar()
    settings = baseline.Settings(
        today=today, days=DAYS, formats=(0, 2), excluded_groups=(0,), promo_days="exclude", min_days=MIN_DAYS,
        min_promo_days=MIN_PROMO_DAYS,
    )
    inputs = baseline.Inputs(
        sales=daily, prices=retail.prices_of_day(daily), reasons=small(retail.reasons_of_actions(spark, sf), "reasons"),
        warehouses=small(retail.warehouses(spark, sf), "warehouses"), clusters=retail.clusters(spark, sf), articles=goods,
        article_info=retail.article_info(goods), calendar=retail.promo_calendar(spark, sf),
        holidays=retail.holiday_coefficients(spark, sf), seasons=retail.season_coefficients(spark, sf),
        elasticity=materialise(article_trends, "article-trends"),
    )
    return inputs, settings


FRAME_ENTITIES = "daily reasons clusters seasons holidays articles warehouses promo_calendar"
_FACTOR = ", ".join(baseline.FACTOR_GROUP)
_FRAME = f"""bounds AS (SELECT max(CAST(l_shipdate AS DATE)) + 1 AS today FROM lineitem),
sales AS MATERIALIZED (SELECT d.* FROM daily d, bounds WHERE day_id BETWEEN today - {DAYS} AND today - 1 AND (rest_qnty > 0 OR sales_qnty > 0)
  AND NOT EXISTS (SELECT 1 FROM promo_calendar p WHERE p.whs_id = d.whs_id AND p.art_id = d.art_id AND d.day_id BETWEEN p.beg_dt AND p.end_dt)),
eligible AS (SELECT whs_id, art_id, frmt_id, branch_id, coalesce(cluster_id, 1) AS cluster_id, art_grp_lvl_3_id
  FROM (SELECT whs_id, art_id FROM sales GROUP BY ALL HAVING count(DISTINCT day_id) >= {MIN_DAYS})
  JOIN warehouses USING (whs_id) JOIN articles USING (art_id) LEFT JOIN clusters USING (whs_id) WHERE frmt_id IN (0, 2)),
found AS (SELECT e.*, coalesce(s.exp_trend_a, g.exp_trend_a)::DOUBLE AS a, coalesce(s.exp_trend_b, g.exp_trend_b)::DOUBLE AS b FROM eligible e
  LEFT JOIN (SELECT * FROM by_article QUALIFY row_number() OVER (PARTITION BY art_id, frmt_id ORDER BY exp_trend_a, exp_trend_b) = 1) s
    ON s.art_id = e.art_id AND s.frmt_id = e.frmt_id
  LEFT JOIN (SELECT * FROM by_article WHERE frmt_id = -1 QUALIFY row_number() OVER (PARTITION BY art_id ORDER BY exp_trend_a, exp_trend_b) = 1) g
    ON g.art_id = e.art_id
  WHERE coalesce(s.exp_trend_a, g.exp_trend_a) IS NOT NULL AND coalesce(s.exp_trend_b, g.exp_trend_b) IS NOT NULL),
season AS (SELECT {_FACTOR}, yearday_id, avg(greatest(exp(koef_yearly), 0.5)) AS coef_season FROM seasons GROUP BY ALL),
holiday AS (SELECT {_FACTOR}, day_id, exp(sum(koeff_holiday)) AS coef_holiday FROM holidays GROUP BY ALL),
frame AS (SELECT s.*, f.* EXCLUDE (whs_id, art_id), gross / sales_qnty AS regular_price, coef_season, coef_holiday,
    (sale + coalesce(disc_loyal, 0)) / sales_qnty AS target_price,
    CASE WHEN coalesce(reason_type_id, 24185) IN (24062, 21001) AND 1 - sale / sales_qnty / (gross / sales_qnty) < 0.05 THEN 1
      WHEN coalesce(reason_type_id, 24185) = 24185 AND 1 - sale / sales_qnty / (gross / sales_qnty) >= 0.05 THEN 0 ELSE 2 END AS k
  FROM sales s JOIN found f USING (whs_id, art_id) LEFT JOIN reasons r ON r.action_type_id = s.action_type_id
  LEFT JOIN season USING ({_FACTOR}) LEFT JOIN holiday USING ({_FACTOR}, day_id)
  WHERE coalesce(yearday_id, month(day_id) * 100 + day(day_id)) = month(day_id) * 100 + day(day_id)),
counted AS (SELECT *, count(*) OVER w AS days_all, count(*) FILTER (k = 0) OVER w AS days_reg, count(*) FILTER (k = 1) OVER w AS days_promo,
  avg(sales_qnty) FILTER (k = 0) OVER w AS avg_reg, avg(sales_qnty) FILTER (k = 1) OVER w AS avg_promo
  FROM frame WINDOW w AS (PARTITION BY whs_id, art_id)),
marked AS (SELECT *, coalesce(days_promo >= {MIN_PROMO_DAYS} AND days_reg >= {MIN_PROMO_DAYS} AND avg_promo >= avg_reg, false) AS promo_only FROM counted),
kept AS (SELECT *, sales_qnty / coalesce(coef_holiday, 1) / coalesce(coef_season, 1) AS clean,
    CASE WHEN 1 - target_price / regular_price > 0 THEN 1 - target_price / regular_price ELSE 0 END AS disc
  FROM marked WHERE CASE WHEN promo_only THEN days_promo >= {MIN_PROMO_DAYS} AND k = 1 ELSE days_all >= {MIN_DAYS} END),
grown AS MATERIALIZED (SELECT *, least(exp(greatest(-35, least(35, ca + cb * disc))) - exp(ca) + 1, 200) AS coef_growth
  FROM (SELECT *, greatest(-35, least(35, a)) AS ca, greatest(-35, least(35, b)) AS cb FROM kept)),
based AS (SELECT *, clean / nullif(coef_growth, 0) AS qnty FROM grown)"""


@query(with_entities(f"{TREND_ENTITIES} {FRAME_ENTITIES}", _BY_ARTICLE + ",\n" + _FRAME + f"""
SELECT whs_id, art_id, {four_digits_sql('avg(regular_price)')} AS regular_price, 0 AS regular_price_alg, round(sum(sales_qnty), 4) AS sales_qnty,
  round(sum(clean), 4) AS sale_qnty_clean, round(sum(qnty), 4) AS qnty_reg, count(*) AS days_cnt, round(sum(qnty) / count(*), 4) AS sale_qnty_reg_avg
FROM based WHERE qnty >= 0 GROUP BY ALL HAVING sum(qnty) / count(*) > 0 AND avg(regular_price) > 0"""))
def baseline_sales(spark, sf):
    goods = retail.articles(spark, sf)
    article_trends = elasticity.elasticity_by_article(trends(spark, sf), goods, SETTINGS)
    totals = baseline.baseline_sales(*baseline_inputs(spark, sf, article_trends))
    totals = totals.withColumn("regular_price", four_digits(F.col("regular_price")))
    return rounded(totals, ["sales_qnty", "sale_qnty_clean", "qnty_reg", "sale_qnty_reg_avg"])


_SIMPLE_TRENDS = f"""WITH {GROUPS_SQL},
sums AS (SELECT grp_art_id, sum(w) AS sw, sum(w * x) AS swx, sum(w * x * x) AS swxx, sum(w * y) AS swy, sum(w * x * y) AS swxy
  FROM (SELECT *, skidgr / 1000.0::DOUBLE AS x, ln(prir + 1) AS y, least(cnt_int_rows, 15000)::DOUBLE AS w FROM groups) GROUP BY ALL),
slopes AS (SELECT *, -(swxy * sw - swy * swx) / nullif(swxx * sw - swx * swx, 0) AS exp_trend_b FROM sums),
by_article AS MATERIALIZED (SELECT art_id, -1 AS frmt_id, (exp_trend_b * swx + swy) / sw AS exp_trend_a, exp_trend_b
  FROM slopes JOIN articles ON grp_art_id = art_grp_lvl_3_id)"""


def simple_trends(spark, sf):
    """Untrimmed trend of the article's group, over all formats."""
    x = F.col("skidgr") / 1000.0
    fit = aggregates.weighted_log_fit(growth_groups(spark, sf), ["grp_art_id"], x, F.col("prir"), F.col("cnt_int_rows"))
    groups = elasticity.article_groups(retail.articles(spark, sf)).select("art_id", "grp_art_id")
    return groups.join(fit, "grp_art_id").select("art_id", F.lit(-1).alias("frmt_id"), "exp_trend_a", "exp_trend_b")


def cleaned_days(spark, sf):
    inputs, settings = baseline_inputs(spark, sf, simple_trends(spark, sf))
    return baseline.training_frame(inputs, settings)


@query(with_entities(f"growth {FRAME_ENTITIES}", _SIMPLE_TRENDS + ",\n" + _FRAME + f"""
SELECT whs_id, art_id, day_id, round(clean, 4) AS sale_qnty_clean, {four_digits_sql('target_price')} AS target_price FROM kept"""))
def deflated_sales(spark, sf):
    return cleaned_days(spark, sf).select(
        "whs_id", "art_id", "day_id", F.round("sale_qnty_clean", 4).alias("sale_qnty_clean"),
        four_digits(F.col("target_price")).alias("target_price"),
    )


@query(with_entities(f"growth {FRAME_ENTITIES}", _SIMPLE_TRENDS + ",\n" + _FRAME + """
SELECT whs_id, art_id, day_id, round(disc, 4) AS disc_calc, round(coef_growth, 4) AS coef_growth, round(qnty, 4) AS qnty_reg FROM based"""))
def growth_coefficient(spark, sf):
    days = baseline.regular_quantity(cleaned_days(spark, sf))
    return rounded(
        days.select("whs_id", "art_id", "day_id", "disc_calc", "coef_growth", "qnty_reg"),
        ["disc_calc", "coef_growth", "qnty_reg"],
    )
