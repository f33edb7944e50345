"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcurve.catalog.entities_sql import with_entities
from shelfcurve.catalog.registry import four_digits, four_digits_sql, query
from shelfcurve.functions import dates
from shelfcurve.operators import aggregates, joins
from shelfcurve.session import materialise
from shelfcurve.sources import retail
from shelfcurve.sources.retail import table


@query("""
SELECT o_orderpriority, count(*) AS n, round(sum(l_quantity), 4) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def join_inner(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return (
        lines.join(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), on=["o_orderkey"], how="inner")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))
    )


@query("""
SELECT n_name, count(*) AS n, round(avg(l_extendedprice), 4) AS mean_price FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def join_broadcast(spark, sf):
    """Nations are of a fixed number and hinted; for suppliers the planner checks the size."""
    shops = table(spark, sf, "supplier").join(
        F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    small = shops.select("s_suppkey", "n_name")
    return (
        table(spark, sf, "lineitem")
        .join(small, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))
    )


@query(with_entities("warehouses clusters", """
SELECT whs_id, frmt_id, coalesce(cluster_id, 1) AS cluster_id FROM warehouses LEFT JOIN clusters USING (whs_id)"""))
def join_left_default(spark, sf):
    shops = retail.warehouses(spark, sf).select("whs_id", "frmt_id")
    return joins.left_with_defaults(shops, retail.clusters(spark, sf), ["whs_id"], {"cluster_id": 1})


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount = 0.1)""")
def join_anti(spark, sf):
    flagged = table(spark, sf, "lineitem").where("l_discount = 0.1D").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(flagged, "o_orderkey", "left_anti")


@query(with_entities("daily promo_calendar", """
SELECT whs_id, count(*) AS n, round(sum(sales_qnty), 4) AS quantity FROM daily d
WHERE EXISTS (SELECT 1 FROM promo_calendar p WHERE p.whs_id = d.whs_id AND p.art_id = d.art_id
  AND d.day_id BETWEEN p.beg_dt AND p.end_dt) GROUP BY ALL"""))
def join_semi(spark, sf):
    """Days of sales within a promotion."""
    days = joins.interval_days(retail.promo_calendar(spark, sf), ["whs_id", "art_id"], "beg_dt", "end_dt")
    kept = retail.daily_sales(spark, sf).join(days, ["whs_id", "art_id", "day_id"], "left_semi")
    return kept.groupBy("whs_id").agg(F.count("*").alias("n"), F.round(F.sum("sales_qnty"), 4).alias("quantity"))


@query(with_entities("promo_calendar", """
SELECT DISTINCT whs_id, art_id, CAST(unnest(generate_series(beg_dt, end_dt, INTERVAL 1 DAY)) AS DATE) AS day_id
FROM promo_calendar"""))
def interval_to_days(spark, sf):
    return joins.interval_days(retail.promo_calendar(spark, sf), ["whs_id", "art_id"], "beg_dt", "end_dt")


@query(with_entities("pairs promo_calendar", """
SELECT DISTINCT p.whs_id, p.art_id, scnd_begin_dt, scnd_end_dt FROM pairs p JOIN promo_calendar c
ON p.whs_id = c.whs_id AND p.art_id = c.art_id AND beg_dt <= scnd_end_dt AND end_dt >= scnd_begin_dt
WHERE (date_diff('day', greatest(beg_dt, scnd_begin_dt), least(end_dt, scnd_end_dt)) + 1)::DOUBLE
  / (date_diff('day', scnd_begin_dt, scnd_end_dt) + 1) >= 0.7"""))
def interval_overlap_share(spark, sf):
    return joins.overlapped(
        retail.price_pairs(spark, sf), retail.promo_calendar(spark, sf), ["whs_id", "art_id"],
        ("scnd_begin_dt", "scnd_end_dt"), ("beg_dt", "end_dt"), 0.7,
    )


def group_prices(spark, sf):
    """Mean price per hierarchy group, at every level, for each brand and for all brands."""
    goods = retail.articles(spark, sf)
    rows = retail.observations(spark, sf).select("art_id", "price").join(goods, "art_id")
    pairs = F.inline(
        F.array(*[F.struct(F.lit(n).alias("art_grp_lvl"), F.col(f"art_grp_lvl_{n}_id").alias("grp_art_id")) for n in range(4)])
    )
    # the price is summed per article first, so the copies are made of articles
    sums = rows.groupBy(*goods.columns).agg(F.sum("price").alias("s"), F.count("*").alias("n"))
    copies = sums.select("s", "n", "art_grp_2_lvl_1_name", pairs).select(
        "s", "n", "art_grp_lvl", "grp_art_id", F.explode(F.array("art_grp_2_lvl_1_name", F.lit("-1"))).alias("brand")
    )
    return copies.groupBy("art_grp_lvl", "grp_art_id", "brand").agg((F.sum("s") / F.sum("n")).alias("mean_price"))


GROUP_PRICES_SQL = with_entities("observations articles", """
WITH groups AS MATERIALIZED (SELECT art_grp_lvl, grp_art_id, brand, avg(price) AS mean_price FROM observations JOIN articles USING (art_id),
  LATERAL (VALUES (0, art_grp_lvl_0_id), (1, art_grp_lvl_1_id), (2, art_grp_lvl_2_id), (3, art_grp_lvl_3_id)) l(art_grp_lvl, grp_art_id),
  LATERAL (VALUES (art_grp_2_lvl_1_name), ('-1')) b(brand) GROUP BY ALL),
matched AS MATERIALIZED (SELECT art_id, art_grp_lvl, grp_art_id, brand, mean_price FROM articles a JOIN groups g ON (
  (grp_art_id = art_grp_lvl_3_id AND art_grp_lvl = 3) OR (grp_art_id = art_grp_lvl_2_id AND art_grp_lvl = 2)
  OR (grp_art_id = art_grp_lvl_1_id AND art_grp_lvl = 1) OR (grp_art_id = art_grp_lvl_0_id AND art_grp_lvl = 0))
  AND (brand = art_grp_2_lvl_1_name OR brand = '-1'))
""")


def matched_groups(spark, sf):
    return joins.match_hierarchy(
        retail.articles(spark, sf), group_prices(spark, sf), "art_id",
        {n: f"art_grp_lvl_{n}_id" for n in range(4)}, "art_grp_2_lvl_1_name",
    )


MATCHED = f"SELECT art_id, art_grp_lvl, grp_art_id, brand, {four_digits_sql('mean_price')} AS mean_price FROM matched"


@query(GROUP_PRICES_SQL + MATCHED)
def hierarchy_match(spark, sf):
    return matched_groups(spark, sf).withColumn("mean_price", four_digits(F.col("mean_price")))


@query(with_entities("observations", """
SELECT art_id, count(*) AS n, count(CASE WHEN abs(price - m) > 1.5 * sd THEN 1 END) AS far
FROM observations JOIN (SELECT art_id, avg(price) AS m, stddev_pop(price) AS sd FROM observations GROUP BY ALL) USING (art_id)
GROUP BY ALL"""))
def stats_join_back(spark, sf):
    # written once, as it is read for the statistics and for the join
    rows = materialise(retail.observations(spark, sf).select("art_id", "price"), "prices")
    stats = aggregates.mean_and_spread(rows, ["art_id"], ["price"])
    far = F.abs(F.col("price") - F.col("avg_price")) > F.col("std_price") * 1.5
    return joins.join_group_stats(rows, stats, ["art_id"]).groupBy("art_id").agg(
        F.count("*").alias("n"), F.count(F.when(far, 1)).alias("far")
    )


@query("""
SELECT c_mktsegment, n_name, p_brand, count(*) AS n, round(sum(l_quantity), 4) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL""")
def star_join(spark, sf):
    # the dimensions are joined first, so that the fact is shuffled by one key only
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf, "lineitem")
        .join(orders.select("o_orderkey", "c_mktsegment"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("c_mktsegment", "n_name", "p_brand")
        .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))
    )


@query(with_entities("observations warehouses", f"""
WITH by_format AS (SELECT art_id, frmt_id, avg(price) AS mean_price FROM observations JOIN warehouses USING (whs_id)
  WHERE frmt_id <> 1 GROUP BY ALL),
general AS (SELECT art_id, avg(price) AS mean_price FROM observations GROUP BY ALL)
SELECT p.whs_id, p.art_id, p.frmt_id, {four_digits_sql('coalesce(f.mean_price, g.mean_price)')} AS mean_price
FROM (SELECT DISTINCT whs_id, art_id, frmt_id FROM observations JOIN warehouses USING (whs_id)) p
LEFT JOIN by_format f ON p.art_id = f.art_id AND p.frmt_id = f.frmt_id LEFT JOIN general g ON p.art_id = g.art_id"""))
def lookup_with_fallback(spark, sf):
    rows = retail.observations(spark, sf).select("whs_id", "art_id", "price")
    rows = rows.join(retail.warehouses(spark, sf).select("whs_id", "frmt_id"), "whs_id")
    mean = F.avg("price").alias("mean_price")
    specific = rows.where("frmt_id <> 1").groupBy("art_id", "frmt_id").agg(mean)
    generic = rows.groupBy("art_id").agg(mean)
    found = joins.lookup_with_fallback(
        rows.select("whs_id", "art_id", "frmt_id").distinct(), specific, generic,
        ["art_id", "frmt_id"], ["art_id"], ["mean_price"],
    )
    return found.withColumn("mean_price", four_digits(F.col("mean_price")))


@query(with_entities("days", """
SELECT day_id, row_count FROM days JOIN (SELECT (year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS part, count(*) AS row_count
  FROM lineitem GROUP BY ALL) ON part = (year(day_id) - 1995) * 12 + month(day_id) WHERE row_count > 0"""))
def partition_row_counts(spark, sf):
    """Rows per monthly partition, shown at each day of the partition."""
    def number(day):
        return dates.month_number(F.col(day), 1995).alias("part")

    counts = table(spark, sf, "lineitem").groupBy(number("l_shipdate")).agg(F.count("*").alias("row_count"))
    days = retail.calendar(spark, sf).select("day_id", number("day_id"))
    return days.join(counts.where("row_count > 0"), "part").select("day_id", "row_count").orderBy("day_id")


@query("""
SELECT r_name, n_name, count(*) AS people FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def dimension_chain(spark, sf):
    """Person, city and region as typed dimensions."""
    people = retail.people(spark, sf)
    cities = retail.cities(spark, sf).select(F.col("id").alias("city"), "region_id", F.col("name").alias("n_name"))
    regions = retail.regions(spark, sf).select(F.col("id").alias("region_id"), F.col("name").alias("r_name"))
    # counted per city first, so the dimensions meet one row per city
    counted = people.groupBy("city").agg(F.count("*").alias("people"))
    return counted.join(cities, "city").join(regions, "region_id").select("r_name", "n_name", "people")


@query("""
SELECT name, balance FROM (SELECT s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_name, c_acctbal FROM customer) ORDER BY balance, name""")
def merge_ordered(spark, sf):
    shops = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    people = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return joins.merge_ordered(shops, people, ["balance", "name"])
