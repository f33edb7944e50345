"""Windows, order, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcurve.catalog.entities_sql import with_entities
from shelfcurve.catalog.grouping import GROUPS_SQL, growth_groups
from shelfcurve.catalog.joining import GROUP_PRICES_SQL, MATCHED, matched_groups
from shelfcurve.catalog.registry import four_digits, query
from shelfcurve.operators import aggregates, history, windows
from shelfcurve.session import new_path
from shelfcurve.sources.retail import table

NEWEST = "ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC"


@query(f"""
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey {NEWEST}) = 1""")
def latest_per_key(spark, sf):
    order = [F.col(c).desc() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    return windows.first_per_key(table(spark, sf, "lineitem"), ["l_suppkey"], order).select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query("""
SELECT l_partkey, l_extendedprice, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_quantity) = 1""")
def first_per_key(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    return windows.first_per_key(rows, ["l_partkey"], ["l_extendedprice", "l_quantity"])


@query(GROUP_PRICES_SQL + MATCHED + """
QUALIFY rank() OVER (PARTITION BY art_id ORDER BY art_grp_lvl DESC, CASE WHEN brand = '-1' THEN 1 ELSE 0 END) = 1""")
def best_match_rank(spark, sf):
    order = [-F.col("art_grp_lvl"), (F.col("brand") == "-1").cast("int")]
    best = windows.best_per_key(matched_groups(spark, sf), ["art_id"], order)
    return best.withColumn("mean_price", four_digits(F.col("mean_price")))


@query(with_entities("growth", f"""
WITH {GROUPS_SQL}
SELECT grp_art_id, skidgr, cnt_int_rows FROM groups WHERE cnt_int_rows >= 10
QUALIFY count(*) OVER (PARTITION BY grp_art_id) > 3
  AND max(skidgr) OVER (PARTITION BY grp_art_id) - min(skidgr) OVER (PARTITION BY grp_art_id) > 200"""))
def window_span_filter(spark, sf):
    bins = growth_groups(spark, sf).where("cnt_int_rows >= 10").select("grp_art_id", "skidgr", "cnt_int_rows")
    return windows.span_filter(bins, ["grp_art_id"], "skidgr", 3, 200)


@query("""
SELECT DISTINCT l_suppkey, l_returnflag, round(sum(l_quantity) OVER w, 4) AS total, round(avg(l_discount) OVER w, 4) AS mean_discount,
  min(l_extendedprice) OVER w AS lowest, max(l_extendedprice) OVER w AS highest, count(*) OVER w AS n
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_returnflag)""")
def window_totals(spark, sf):
    """Totals of a partition with one row kept: a plain aggregate."""
    return table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.round(F.sum("l_quantity"), 4).alias("total"), F.round(F.avg("l_discount"), 4).alias("mean_discount"),
        F.min("l_extendedprice").alias("lowest"), F.max("l_extendedprice").alias("highest"), F.count("*").alias("n"),
    )


@query("""
SELECT o_orderkey, o_totalprice, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM orders""")
def running_total(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    totals = windows.running_total(orders, ["o_orderdate", "o_orderkey"], "o_totalprice")
    return totals.select("o_orderkey", "o_totalprice", F.round("running_total", 2).alias("running_total"))


@query("SELECT row_number() OVER (ORDER BY ts, event_id) AS id, event_id, user_id FROM events")
def surrogate_key(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return windows.surrogate_key(events, ["ts", "event_id"]).select("id", "event_id", "user_id")


# When the profiles are taken.
TAKEN = [f"{year}-01-01" for year in range(1996, 2003)]


def _drift_sql(name: str, day: str) -> str:
    taken = ", ".join(f"(DATE '{t}')" for t in TAKEN)
    return f"SELECT '{name}' AS table_name, taken_at, count({day}) AS row_count FROM (VALUES {taken}) t(taken_at) LEFT JOIN {name} ON {day} < taken_at GROUP BY ALL"


@query(f"""
WITH history AS ({_drift_sql('orders', 'o_orderdate')} UNION ALL {_drift_sql('lineitem', 'l_shipdate')})
SELECT *, row_count - lag(row_count) OVER (PARTITION BY table_name ORDER BY taken_at) AS change FROM history""")
def profile_drift(spark, sf):
    """Profiles of two growing tables, taken once a year into a history; the last run comes twice."""
    path = new_path(spark, "profiles")
    for taken in [*TAKEN, TAKEN[-1]]:
        day = F.lit(taken).cast("date")
        then = [(name, table(spark, sf, name).where(F.col(c) < day)) for name, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
        profiles = [aggregates.table_profile(rows, name, day) for name, rows in then]
        history.append_profiles(profiles[0].unionByName(profiles[1]), path)
    kept = history.read_history(spark, path).select("table_name", "taken_at", "row_count")
    return windows.change_between_snapshots(kept, "table_name", "taken_at", "row_count")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)
