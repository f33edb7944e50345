"""Hand-made cases for the two jobs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfcurve.plans import baseline, elasticity

D = datetime.date

PAIR = (
    "whs_id int, art_id int, algorithm_type int, scnd_reason_type_id int, scnd_holiday_id int, ssn_coef_sale_txn double, "
    "frst_price double, frst_sale_qnty double, frst_day_cnt_rest_sales int, frst_client_cnt int, frst_txn_cnt int, "
    "frst_begin_dt date, frst_end_dt date, "
    "scnd_price double, scnd_sale_qnty double, scnd_day_cnt_rest_sales int, scnd_client_cnt int, scnd_txn_cnt int, "
    "scnd_begin_dt date, scnd_end_dt date"
)


def pair(whs=1, art=1, algorithm=1, p1=10.0, p2=8.0, q1=10.0, q2=20.0, season=2.0, begin=D(2019, 6, 1), days=10, n1=10, n2=5):
    end, second = begin + datetime.timedelta(days=days - 1), begin + datetime.timedelta(days=days)
    return (
        whs, art, algorithm, 21001, None, season, p1, q1, n1, 4, 4, begin, end,
        p2, q2, n2, 8, 2, second, second + datetime.timedelta(days=days - 1),
    )


@pytest.fixture
def dims(rows):
    arts = rows(
        "art_id int, direction int, art_grp_lvl_0_id int, art_grp_lvl_1_id int, art_grp_lvl_2_id int, art_grp_lvl_3_id int, art_grp_2_lvl_1_name string",
        (1, 3, 1, 10, 100, 1000, "Acme ооо"), (2, 1, 1, 10, 100, 1001, "Best"), (3, 1, 1, 10, 101, 1002, None),
    )
    shops = rows("whs_id int, gs_fo_id int, frmt_id int, branch_id int", (1, 1071315, 2, 5), (2, 7, 1, 6))
    return arts, shops


def test_article_groups(dims, values):
    arts, _ = dims
    assert values(elasticity.article_groups(arts)) == [
        (1, 1000, 34, "aсme"), (2, 1001, 12, "best"), (3, 1002, 12, None),
    ]
    assert values(elasticity.article_groups(arts, 2, any_brand=True))[0] == (1, 100, 34, "-1")


def test_growth_measures(rows, dims):
    arts, shops = dims
    pairs = rows(PAIR, pair(), pair(season=0.0), pair(q2=1.0))
    df = elasticity.growth_measures(pairs, elasticity.article_groups(arts), elasticity.remap_regions(shops))
    found = sorted(df.collect(), key=lambda r: r.prir_ssn is None)
    assert len(found) == 2  # the pair whose sales fell is gone
    r = found[0]
    assert (float(r.disc), r.skidgr, r.gs_fo_id, r.aum_type_id, r.scnd_holiday_id) == (-0.2, -200, 481752, 1, 0)
    assert (r.prir_sale, r.prir_client, r.prir_txn, r.prir_ssn) == (3.0, 0.0, 3.0, 0.0)
    assert found[1].prir_ssn is None


def test_valid_pairs(rows):
    good = pair()
    bad = [pair(p2=11.0), pair(q1=0.0), pair(n2=0), pair(begin=D(2020, 2, 25)), pair(begin=D(2022, 3, 1))]
    kept = elasticity.valid_pairs(rows(PAIR, good, *bad, pair(n1=0), pair(p2=10.0)))
    assert kept.count() == 3  # the days of the first period may be zero, the price may stay


def promotions(rows, campaigns=(), calendar=()):
    headers = rows(
        "mc_id int, action_id int, art_id int, status_id int, begin_dt date, end_dt date, load_dtm int", *campaigns
    )
    return elasticity.Promotions(
        headers, rows("mc_id int, whs_id int", (1, 1), (1, 2), (2, 1)), rows("action_id int, name string", (5, "Акция ДМП"), (6, "x")),
        rows("whs_id int, art_id int, market_company_id int, beg_dt date, end_dt date", *calendar),
    )


def excluded(rows, pairs, promo):
    s, since = elasticity.Settings(), F.lit(D(2019, 1, 1))
    promoted = elasticity.promoted_periods(pairs, promo, since, s)
    return pairs.count() - elasticity.without_promoted(pairs, promoted).count()


def test_calendar_ignores_the_algorithm_and_campaigns_do_not(rows):
    # the first period of the second pair is under promotion by its own length only
    one, two = pair(algorithm=1, days=10), pair(algorithm=2, days=40)
    pairs = rows(PAIR, one, two)
    span = (D(2019, 6, 1), D(2019, 6, 10))
    assert excluded(rows, pairs, promotions(rows, campaigns=[(1, 5, 1, 411, *span, 1)])) == 1
    assert excluded(rows, pairs, promotions(rows, calendar=[(1, 1, 1, *span)], campaigns=[])) == 2
    assert excluded(rows, pairs, promotions(rows, calendar=[(1, 1, 2, *span)])) == 0


def test_only_the_latest_matching_header_counts(rows):
    pairs, span = rows(PAIR, pair()), (D(2019, 6, 1), D(2019, 6, 10))
    later = (D(2019, 9, 1), D(2019, 9, 10))
    assert excluded(rows, pairs, promotions(rows, [(1, 5, 1, 411, *span, 1), (1, 5, 1, 411, *later, 2)])) == 0
    assert excluded(rows, pairs, promotions(rows, [(1, 5, 1, 411, *later, 1), (1, 5, 1, 411, *span, 2)])) == 1
    # a header with another status or an end before the horizon does not take part
    assert excluded(rows, pairs, promotions(rows, [(1, 5, 1, 411, *span, 1), (1, 5, 1, 9, *later, 2)])) == 1
    old = (D(2018, 9, 1), D(2018, 9, 10))
    assert excluded(rows, pairs, promotions(rows, [(1, 5, 1, 411, *span, 1), (1, 5, 1, 411, *old, 2)])) == 1
    assert excluded(rows, pairs, promotions(rows, [(1, 6, 1, 411, *span, 1)])) == 0


TREND = (
    "grp_art_id int, brand string, gs_fo_id int, frmt_id int, algorithm_type int, wo_dmp int, art_grp_lvl int, "
    "exp_trend_a double, exp_trend_b double"
)


def test_best_trend_of_an_article(rows, dims):
    arts, _ = dims
    trends = rows(
        TREND,
        (1000, "-1", -1, -1, 1, 1, 3, 0.1, 1.0), (1000, "aсme", -1, -1, 1, 1, 3, 0.2, 1.0),
        (100, "-1", -1, -1, 1, 1, 2, 0.3, 1.0), (100, "-1", -1, 2, 1, 1, 2, 0.4, 1.0),
        (1001, "-1", 5, -1, 1, 1, 3, 0.5, 1.0), (1001, "-1", -1, -1, 2, 1, 3, 0.6, 1.0), (1001, "-1", -1, -1, 1, 1, 3, 0.7, -0.1),
        (101, "-1", -1, -1, 1, 1, 2, 0.8, 1.0), (101, "-1", -1, -1, 1, 1, 2, 0.9, 1.0),
    )
    found = elasticity.elasticity_by_article(trends, arts).collect()
    got = sorted((r.art_id, r.frmt_id, round(r.exp_trend_a, 3)) for r in found)
    # article 3 has two trends of the same rank: both stay
    assert got == [(1, -1, 0.2), (1, 2, 0.4), (2, -1, 0.3), (2, 2, 0.4), (3, -1, 0.8), (3, -1, 0.9)]
    assert all(r.coef_dmp is None and r.num_order == 1 for r in found)


def test_slope_is_judged_after_rounding(rows, dims):
    arts, _ = dims
    trends = rows(TREND, (1000, "-1", -1, -1, 1, 1, 3, 0.1, -0.0004), (1001, "-1", -1, -1, 1, 1, 3, 0.1, -0.0006))
    assert [r.art_id for r in elasticity.elasticity_by_article(trends, arts).collect()] == [1]


def test_metrics_are_a_setting(spark, values):
    """Wide bands: the profile of each metric and level is that of plain grouping, NULL brands included."""
    rng = random.Random(3)
    data = [
        (1, rng.choice(["a", "b", None]), rng.randrange(2), rng.randrange(2), 1, -100 * rng.randrange(3), -0.1 * rng.random(),
         *[rng.choice([rng.random(), None]) for _ in elasticity.METRICS])
        for _ in range(500)
    ]
    names = ", ".join(f"prir_{m} double" for m in elasticity.METRICS)
    df = spark.createDataFrame(data, f"grp_art_id int, brand string, gs_fo_id int, frmt_id int, algorithm_type int, skidgr int, disc double, {names}")
    s = elasticity.Settings(metrics=("sale", "txn"), sigmas=(1000.0,))
    keys = [*elasticity.GROUP, *elasticity.LEVEL, "skidgr"]
    digits = lambda df: values(df.withColumns({c: F.round(c, 9) for c in ("av_disc", "prir", "stddev_koeff")}))
    got = elasticity.trimmed_profile(df, s)
    plain = None
    for number, m in ((1, "sale"), (3, "txn")):
        rows = elasticity.rollup(df).dropna("any", subset=keys).where(F.col(f"prir_{m}").isNotNull())
        part = rows.groupBy(*keys, F.lit(number).alias("type_prirost")).agg(
            F.avg("disc").alias("av_disc"), F.avg(f"prir_{m}").alias("prir"), F.stddev_pop(f"prir_{m}").alias("stddev_koeff"),
            F.count("*").alias("cnt_int_rows"),
        )
        plain = part if plain is None else plain.unionByName(part)
    assert digits(got.select(plain.columns)) == digits(plain)


# --- baseline -------------------------------------------------------------------------

SALES = "whs_id int, art_id int, day_id date, sales_qnty double, rest_qnty double, sale double, disc_loyal double, disc_ma_qnty double, action_type_id int"
GROUP = "frmt_id int, branch_id int, cluster_id int, art_grp_lvl_3_id int"


def a_day(n):
    return D(2024, 3, 1) + datetime.timedelta(days=n)


def inputs(rows, dims, sales, reasons=((1, 24185), (2, 21001)), calendar=(), prices=None, elastic=((1, -1, 0.0, 1.0),), info=()):
    arts, shops = dims
    prices = prices or [(r[0], r[1], r[2], 8.0, 10.0) for r in sales]
    return baseline.Inputs(
        sales=rows(SALES, *sales),
        prices=rows("whs_id int, art_id int, day_id date, factual_price double, regular_price double", *prices),
        reasons=rows("action_type_id int, reason_type_id int", *reasons),
        warehouses=shops,
        clusters=rows("whs_id int, cluster_id int", (2, 4)),
        articles=arts,
        article_info=rows("art_id int, is_sp_gm int", *info),
        calendar=rows("whs_id int, art_id int, market_company_id int, beg_dt date, end_dt date", *calendar),
        holidays=rows(GROUP + ", day_id date, koeff_holiday double", (2, 5, 1, 1000, a_day(0), 0.5), (2, 5, 1, 1000, a_day(0), 0.2)),
        seasons=rows(GROUP + ", yearday_id int, koef_yearly double", (2, 5, 1, 1000, 302, -3.0), (2, 5, 1, 1000, 302, 0.0)),
        elasticity=rows("art_id int, frmt_id int, exp_trend_a float, exp_trend_b float", *elastic),
    )


def settings(**kw):
    return baseline.Settings(**{"today": F.lit(D(2024, 4, 1)), "promo_days": "exclude", **kw})


def sale(n, quantity=4.0, action=1, art=1, whs=1, stock=1.0):
    return (whs, art, a_day(n), quantity, stock, quantity * 8.0, None, None, action)


def test_baseline_of_regular_days(rows, dims):
    import math

    found = baseline.baseline_sales(inputs(rows, dims, [sale(n) for n in range(14)]), settings()).collect()
    assert len(found) == 1
    growth = math.exp(0.2) - 1 + 1  # a = 0, b = 1, discount 0.2
    season, holiday = (0.5 + 1.0) / 2, math.exp(0.7)
    clean = 12 * 4.0 + 4.0 / holiday + 4.0 / season
    r = found[0]
    assert (r.days_cnt, r.sales_qnty, r.regular_price, r.regular_price_alg) == (14, 56.0, 10.0, 0)
    assert r.sale_qnty_clean == pytest.approx(clean)
    assert r.qnty_reg == pytest.approx(clean / growth)
    assert r.sale_qnty_reg_avg == pytest.approx(clean / growth / 14)


def test_too_few_days_are_deleted(rows, dims):
    assert baseline.baseline_sales(inputs(rows, dims, [sale(n) for n in range(13)]), settings()).count() == 0


def test_other_formats_and_articles_without_elasticity_are_left_out(rows, dims):
    other_shop = [sale(n, whs=2) for n in range(14)]
    no_trend = [sale(n, art=2) for n in range(14)]
    assert baseline.baseline_sales(inputs(rows, dims, other_shop + no_trend), settings()).count() == 0


def test_promo_days_are_kept_or_excluded(rows, dims):
    data = inputs(rows, dims, [sale(n) for n in range(28)], calendar=[(1, 1, 1, a_day(0), a_day(13))])
    for mode in ("keep", "exclude"):
        r = baseline.baseline_sales(data, settings(promo_days=mode)).first()
        assert r.days_cnt == 14
    assert baseline.sales_in_window(data.sales, settings(days=5)).count() == 2


def test_promo_days_alone_train_if_they_sell_more(rows, dims):
    prices = [(1, 1, a_day(n), 8.0, 10.0) for n in range(7)] + [(1, 1, a_day(n), 9.9, 10.0) for n in range(7, 14)]
    strong = [sale(n, 4.0, 1) for n in range(7)] + [sale(n, 5.0, 2) for n in range(7, 14)]
    weak = [sale(n, 4.0, 1) for n in range(7)] + [sale(n, 3.0, 2) for n in range(7, 14)]
    days = [
        baseline.baseline_sales(inputs(rows, dims, s, prices=prices), settings()).first().days_cnt for s in (strong, weak)
    ]
    assert days == [7, 14]


def test_special_articles_count_only_when_sold(rows, dims):
    data = [sale(n) for n in range(14)] + [sale(14, 0.0), sale(15, 0.0, stock=0.0)]
    plain = baseline.baseline_sales(inputs(rows, dims, data), settings()).first()
    special = baseline.baseline_sales(inputs(rows, dims, data, info=[(1, 1)]), settings()).first()
    assert (plain.days_cnt, special.days_cnt) == (15, 14)


def test_specific_trend_goes_before_the_general_one(rows, values):
    pairs = rows("whs_id int, art_id int, " + GROUP, (1, 1, 2, 5, 1, 1000), (1, 2, 2, 5, 1, 1000), (1, 3, 2, 5, 1, 1000))
    table = rows(
        "art_id int, frmt_id int, exp_trend_a double, exp_trend_b double",
        (1, 2, 0.2, 1.0), (1, 2, 0.1, 9.0), (1, -1, 0.0, 0.0), (2, -1, 0.5, 2.0), (3, 1, 0.7, 1.0),
    )
    found = baseline.with_elasticity(pairs, table).select("art_id", "exp_trend_a", "exp_trend_b")
    assert values(found) == [(1, 0.1, 9.0), (2, 0.5, 2.0)]
