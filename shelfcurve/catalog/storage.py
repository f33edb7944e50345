"""Sinks, upserts, audits and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcurve.catalog.registry import query
from shelfcurve.functions import text
from shelfcurve.operators import filters, quality, upsert
from shelfcurve.plans import load, publish
from shelfcurve.session import new_path
from shelfcurve.sources import readers, versions, writers
from shelfcurve.sources.retail import table
from shelfcurve.streaming import mirror


@query("SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")
def write_overwrite(spark, sf):
    orders, path = table(spark, sf, "orders"), new_path(spark, "overwrite")
    writers.overwrite_table(orders.groupBy("o_orderstatus").count(), path)
    totals = orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return writers.overwrite_table(totals, path, partitions=4)


@query("""
SELECT event_id, user_id, CAST(ts AS DATE) AS day_id, CASE WHEN event_type IN ('click', 'view') THEN value END AS value FROM events""")
def partitioned_append(spark, sf):
    """Two loads; the second brings a column that the first does not have."""
    path = new_path(spark, "by-day")
    events = table(spark, sf, "events").withColumn("day_id", F.col("ts").cast("date"))
    shown = F.col("event_type").isin("click", "view")
    load.load_partitioned(events.where(~shown), ["event_id", "user_id", "day_id"], path)
    return load.load_partitioned(events.where(shown), ["event_id", "user_id", "value", "day_id"], path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_export(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = writers.export_csv(rows, new_path(spark, "export-csv"))
    return spark.read.option("header", True).schema(rows.schema).csv(path)


PUBLISHED = """
WITH snapshot AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)),
target AS (SELECT o_orderkey, o_custkey, 0.0::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM snapshot UNION ALL SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM snapshot)"""


@query(PUBLISHED)
def staged_publish(spark, sf):
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    target, path = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)).select(*columns), new_path(spark, "published")
    versions.replace(target, path)
    return publish.publish_snapshot(orders, "o_orderdate", columns, new_path(spark, "stage"), path, ["o_orderkey"])


@query("""
SELECT 'nation' AS level, n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
UNION ALL SELECT 'region', r_name, count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def union_levels(spark, sf):
    people = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )

    def level(name, column):
        counted = people.groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))
        return counted.select(F.lit(name).alias("level"), "name", "n")

    return level("nation", "n_name").unionByName(level("region", "r_name"))


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS o_totalprice FROM orders
WHERE o_orderstatus IN ('F', 'O') OR o_totalprice < 100000""")
def merge_upsert(spark, sf):
    """Cheap orders and finished ones meet updates of open and finished ones."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = orders.where("o_totalprice < 100000").withColumn("o_totalprice", F.lit(0.0))
    opened = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(0.0))
    source = orders.where("o_orderstatus = 'F'").unionByName(opened)
    return upsert.merge_upsert(target, source, ["o_orderkey"])


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 0 ELSE 1 END AS is_ready FROM customer""")
def update_flag(spark, sf):
    jobs = table(spark, sf, "customer").withColumn("is_ready", F.lit(1))
    chosen = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return filters.update_flag(jobs, "is_ready", 0, chosen).select("c_custkey", "is_ready")


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'O' AND o_totalprice > 50000, false)""")
def delete_where(spark, sf):
    gone = (F.nullif("o_orderstatus", F.lit("P")) == "O") & (F.col("o_totalprice") > 50000)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return filters.delete_where(orders, gone).select("o_orderkey", "o_custkey")


@query("""
SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'error') THEN value ELSE -1 END AS value FROM events
WHERE event_type <> 'view'""")
def partition_move(spark, sf):
    """Two partitions of the source take the place of the same ones of the target."""
    path = new_path(spark, "moved")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    target = events.where("event_type <> 'view'").withColumn("value", F.lit(-1.0))
    target.write.partitionBy("event_type").parquet(path)
    moved = writers.move_partitions(events.where(F.col("event_type").isin("click", "error")), path, "event_type")
    return moved.select("event_id", "event_type", "value")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def audit_primary_key(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT c_nationkey AS key, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)
GROUP BY ALL""")
def audit_foreign_key(spark, sf):
    parents = table(spark, sf, "nation").where("n_regionkey <> 2")
    return quality.missing_references(table(spark, sf, "customer"), "c_nationkey", parents, "n_nationkey")


@query("""
SELECT c_nationkey AS key, count(*) AS n, CASE WHEN max(n_regionkey) < 3 THEN 'primary' WHEN max(n_regionkey) = 3 THEN 'misrouted'
  ELSE 'orphan' END AS status FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def audit_misrouted_keys(spark, sf):
    """Nations of one region sit in another dimension, those of a second one are missing."""
    nation = table(spark, sf, "nation")
    return quality.resolve_keys(
        table(spark, sf, "customer"), "c_nationkey", nation.where("n_regionkey < 3"), nation.where("n_regionkey = 3"),
        "n_nationkey",
    )


@query("SELECT c_custkey, c_name AS name FROM customer")
def clean_names(spark, sf):
    kind = F.col("c_custkey") % 4
    tail = F.when(kind == 0, "\\r\\n").when(kind == 1, "\\n").when(kind == 2, "\r\n").otherwise("")
    return table(spark, sf, "customer").select(
        "c_custkey", text.strip_line_breaks(F.concat("c_name", tail)).alias("name")
    )


@query("""
SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert(spark, sf):
    """A mirror with the newest event of each user. The events come in several batches, the
    newer half first, so the order of arrival is not that of the events."""
    columns = ["user_id", "event_id", "event_type", "value", "ts"]
    schema = table(spark, sf, "events").schema
    path, checkpoint = new_path(spark, "mirror"), new_path(spark, "mirror-checkpoint")
    events, folder = table(spark, sf, "events"), new_path(spark, "mirror-input")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg(F.percentile_approx(micros, 0.5)).scalar()
    newest_first = [F.col("ts").desc(), F.col("event_id").desc()]
    for newer in (True, False):
        events.where((micros >= middle) == F.lit(newer)).write.mode("append").parquet(folder)
        stream = mirror.file_stream(spark, folder, schema).select(*columns)
        mirror.upsert_stream(stream, path, checkpoint, ["user_id"], newest_first)
    return mirror.read_mirror(spark, path, ["user_id"], newest_first).drop("ts")


@query("SELECT event_id, event_type, value, CAST(ts AS DATE) AS day_id FROM events")
def stream_partitioned_append(spark, sf):
    schema = table(spark, sf, "events").schema
    path, checkpoint = new_path(spark, "stream-by-day"), new_path(spark, "stream-checkpoint")
    stream = mirror.file_stream(spark, sf, schema, "events.parquet").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("day_id")
    )
    mirror.append_by_day(stream, path, checkpoint, "day_id")
    return readers.scan_table(spark, path, ["event_id", "event_type", "value", "day_id"])
