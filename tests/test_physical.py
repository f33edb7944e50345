"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from shelfcurve.catalog import QUERIES, pricing
from shelfcurve.operators import joins
from shelfcurve.plans import baseline, elasticity
from shelfcurve.sources import retail


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(name, spark):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


def test_first_per_key_limits_before_the_shuffle(spark, sf_dir):
    plan = plan_of(contract.queries()["latest_per_key"](spark, sf_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_reads_and_filters_in_the_file(spark, sf_dir):
    plan = plan_of(contract.queries()["scan_table"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_quantity,45.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan


@pytest.mark.parametrize("name", ["growth_measures", "sigma_trim", "masked_levels"])
def test_pairs_scan_no_lines_after_the_ranges_are_written(name, spark, sf_dir):
    assert "lineitem.parquet" not in plan_of(contract.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["running_total", "surrogate_key"])
def test_ordered_queries_do_not_shuffle_rows_again(name, spark, sf_dir):
    assert "hashpartitioning" not in plan_of(QUERIES[name](spark, sf_dir))


def test_pairs_do_not_shuffle_again(spark, sf_dir):
    assert "hashpartitioning" not in plan_of(retail.price_pairs(spark, sf_dir))


def test_pairs_do_not_depend_on_the_ranges(spark, sf_dir):
    def total(ranges):
        df = retail.price_pairs(spark, sf_dir, ranges)
        return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()

    assert total(3) == total(50)


@pytest.fixture
def no_broadcasts(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_sales_lie_by_the_keys_they_meet_prices_by(spark, no_broadcasts):
    sf = "/root/testdata/sf0.001"
    inputs, _ = pricing.baseline_inputs(spark, sf, pricing.simple_trends(spark, sf))
    assert "Exchange" not in plan_of(inputs.sales.join(inputs.prices, baseline.PAIR_DAY))


@pytest.mark.parametrize("name", ["deflated_sales", "growth_coefficient"])
def test_stored_days_move_by_their_pair_only(name, spark, no_broadcasts):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    # the one exchange by days is that of counting them, of partial sums
    assert len(re.findall(r"hashpartitioning\(whs_id#\d+L?, art_id#\d+, day_id#", plan)) <= 1


@pytest.mark.parametrize("name", ["deflated_sales", "growth_coefficient"])
def test_days_are_counted_without_an_exchange_of_days(name, spark, no_broadcasts):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert not re.findall(r"hashpartitioning\(whs_id#\d+L?, art_id#\d+, day_id#", plan)


def test_stored_ranges_have_no_price(spark, sf_dir):
    """It is made of three other stored columns."""
    scans = [x for x in plan_of(retail.price_pairs(spark, sf_dir)).splitlines() if "FileScan" in x]
    assert scans and not any(re.search(r"\bprice#", x) for x in scans)


def test_methods_of_the_rollup_are_small_enough_for_the_compiler(spark):
    """The JVM interprets methods of more than 8,000 bytes."""
    names = [
        *baseline.PAIR, "sales_qnty", "opsum", "factual_price", "regular_price", "target_price", "is_txn_disc",
        "coef_holiday", "coef_season", "exp_trend_a", "exp_trend_b",
    ]
    days = spark.range(1000).select(*[(F.col("id") % n + 1).cast("double").alias(c) for n, c in enumerate(names, 2)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        totals = baseline.baseline_rollup(baseline.regular_quantity(baseline.deflated_sales(days)))
        text = spark._jvm.PythonSQLUtils.explainString(totals._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_bins_of_intervals_are_not_broadcast(spark):
    """They are a multiple of the intervals whose size the planner sees."""
    spans = spark.range(1000).selectExpr("id % 5 AS k", "date_add(DATE '2024-01-01', int(id)) AS b", "date_add(DATE '2024-01-01', int(id) + 9) AS e")
    assert "BroadcastHashJoin" not in plan_of(joins.overlapped(spans, spans, ["k"], ("b", "e"), ("b", "e"), 0.5))


def test_filters_on_pairs_read_the_row_before_as_columns(spark, sf_dir):
    filters = [x for x in plan_of(elasticity.valid_pairs(retail.price_pairs(spark, sf_dir))).splitlines() if "Filter" in x and "previous_price" in x]
    assert filters and not any("_inside" in x for x in filters)
