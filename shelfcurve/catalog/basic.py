"""Scans, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from shelfcurve.catalog.entities_sql import DISCOUNT_BIN, with_entities
from shelfcurve.catalog.registry import query
from shelfcurve.functions import dates, numeric, predicates, text
from shelfcurve.operators import filters
from shelfcurve.plans import baseline, elasticity
from shelfcurve.session import new_path
from shelfcurve.sources import readers, retail, writers
from shelfcurve.sources.retail import table


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45")
def scan_table(spark, sf):
    return readers.scan_table(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], F.col("l_quantity") >= 45
    )


@query("""
SELECT c_custkey AS people_id, c_name AS fio, c_nationkey AS city, CAST(c_custkey % 2 AS INT) AS sex,
  CAST(18 + c_custkey % 60 AS INT) AS age FROM customer""")
def dimension_seed(spark, sf):
    return retail.people(spark, sf)


@query("""
SELECT title, value, count(*) AS n FROM lineitem JOIN (VALUES ('A', 'accepted', 1), ('N', 'new', 2), ('R', 'returned', 3))
  s(flag, title, value) ON l_returnflag = flag GROUP BY ALL""")
def inline_values(spark, sf):
    flags = readers.inline_values(
        spark, [("A", "accepted", 1), ("N", "new", 2), ("R", "returned", 3)],
        "l_returnflag string, title string, value int",
    )
    # counted before the join: three rows meet three rows
    counted = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return counted.join(flags, "l_returnflag").select("title", "value", "n")


ORDERS_CSV = T.StructType(
    [
        T.StructField("order_key", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("total", T.DoubleType()),
    ]
)


@query("""
SELECT CAST(o_orderkey AS INT) AS order_key, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS total FROM orders""")
def csv_positional_ingest(spark, sf):
    """Padded cells, a header row among the data, and cells that are no numbers."""
    total = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    cells = {
        "order_key": F.col("o_orderkey").cast("string"), "order_date": F.col("o_orderdate").cast("date").cast("string"),
        "status": F.col("o_orderstatus"), "total": total,
    }
    padded = [F.concat(F.lit(" "), c, F.lit("  ")).alias(n) for n, c in cells.items()]
    path = new_path(spark, "positional-csv")
    (
        table(spark, sf, "orders").select(*padded).write.option("header", True).option("sep", ";")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return readers.read_positional_csv(spark, path, ORDERS_CSV, header_column="status")


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def csv_bulk_load(spark, sf):
    path, loaded = new_path(spark, "bulk-csv"), new_path(spark, "bulk-table")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    writers.export_csv(rows, path, sep=";", header=False)
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType())]
    )
    readers.read_bulk_csv(spark, path, schema).write.mode("append").parquet(loaded)
    return spark.read.parquet(loaded)


@query("""
SELECT CAST(user_id AS VARCHAR) || ' -- ' || event_type AS pair, count(*) AS n FROM events
WHERE event_id % 10 > 1 GROUP BY ALL""")
def text_pair_swap(spark, sf):
    """Lines of a text file, with markup lines and empty lines between them."""
    key = F.col("event_id") % 10
    line = (
        F.when(key == 0, F.concat(F.lit("<"), "event_type", F.lit(">")))
        .when(key == 1, "")
        .otherwise(F.concat_ws(" -- ", "event_type", "user_id"))
    )
    path = new_path(spark, "pairs-text")
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    swapped = readers.read_text_pairs(spark, path).select(text.swap_pair(F.col("value")).alias("value"))
    out = new_path(spark, "swapped-text")
    swapped.write.text(out)
    return spark.read.text(out).withColumnRenamed("value", "pair").groupBy("pair").agg(F.count("*").alias("n"))


@query("""
SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k_sum,
  max(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_max FROM events GROUP BY ALL""")
def json_field(spark, sf):
    k = F.from_json("props", "struct<k: bigint>")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))


@query("SELECT doc_id, array_to_string(string_split(text, chr(10))[1:6], '|') AS titles FROM documents")
def json_first_n_titles(spark, sf):
    """Each document as a feed whose entries are titled by its lines."""
    lines = F.split("text", "\n")
    entries = F.transform(lines, lambda x: F.struct(F.struct(x.alias("$t")).alias("title")))
    feed = F.to_json(F.struct(F.struct(entries.alias("entry")).alias("feed")))
    feeds = table(spark, sf, "documents").select("doc_id", feed.alias("feed"))
    return feeds.select("doc_id", F.array_join(text.first_titles(F.col("feed")), "|").alias("titles"))


@query(r"""
WITH body AS (SELECT conv_id, turn,
    regexp_replace(regexp_replace(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n\z', '') AS t
  FROM conversations),
kept AS (SELECT conv_id, turn, substr(t, strpos(t, chr(10)) + 1) AS b FROM body WHERE strpos(t, chr(10)) > 0)
SELECT conv_id, turn, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN b ELSE chr(10) || b END AS piece FROM kept""")
def paragraphs_to_script(spark, sf):
    pieces = readers.notebook_script(table(spark, sf, "conversations"), "conv_id", "turn", "text")
    return writers.write_script(pieces, new_path(spark, "scripts"), "conv_id", "turn").drop("bucket")


@query("SELECT O_ORDERKEY AS o_orderkey, O_ORDERSTATUS AS o_orderstatus, O_TOTALPRICE AS o_totalprice FROM orders")
def lowercase_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return readers.lowercase_columns(orders.toDF(*[c.upper() for c in orders.columns]))


@query(with_entities("valid_pairs", """
SELECT whs_id, art_id, scnd_begin_dt, frst_price, scnd_price FROM valid_pairs"""))
def valid_price_pairs(spark, sf):
    return elasticity.valid_pairs(retail.price_pairs(spark, sf)).select(
        "whs_id", "art_id", "scnd_begin_dt", "frst_price", "scnd_price"
    )


STRIKES = (("1997-03-09", "1997-05-03"), ("1999-02-24", "1999-03-22"))


@query("""
SELECT CAST(year(l_shipdate) AS INT) AS y, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1997-03-09' AND DATE '1997-05-03'
  AND CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1999-02-24' AND DATE '1999-03-22'
  AND CAST(l_shipdate AS DATE) + 13 NOT BETWEEN DATE '1997-03-09' AND DATE '1997-05-03'
  AND CAST(l_shipdate AS DATE) + 13 NOT BETWEEN DATE '1999-02-24' AND DATE '1999-03-22'
GROUP BY ALL""")
def exclude_blackout_periods(spark, sf):
    begin = F.col("l_shipdate").cast("date")
    periods = table(spark, sf, "lineitem").select(begin.alias("b"), F.date_add(begin, 13).alias("e"))
    kept = periods.where(predicates.outside_periods(["b", "e"], STRIKES))
    return kept.groupBy(F.year("b").alias("y")).agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority NOT IN ('5-LOW', '2-HIGH')""")
def filter_in_not_in(spark, sf):
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus").isin("O", "F") & ~F.col("o_orderpriority").isin("5-LOW", "2-HIGH"))
        .select("o_orderkey", "o_orderpriority")
    )


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%'")
def name_contains(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return part.where(text.contains_ignoring_case(F.col("p_name"), "RED"))


@query("""
SELECT CASE WHEN n_regionkey IN (0, 4) THEN 1 WHEN n_regionkey = 3 THEN 2 ELSE n_regionkey END AS gs_fo_id,
  count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def remap_category(spark, sf):
    shops = retail.warehouses(spark, sf).select(
        predicates.remap(F.col("gs_fo_id"), {0: 1, 4: 1, 3: 2}).alias("gs_fo_id")
    )
    return shops.groupBy("gs_fo_id").agg(F.count("*").alias("n"))


@query(with_entities("daily reasons", """
SELECT CASE WHEN reason_type_id IN (21001, 24062) THEN 1 WHEN reason_type_id = 21007 THEN 2
    WHEN reason_type_id = 21004 THEN 3 ELSE 4 END AS aum_type_id,
  CASE WHEN coalesce(reason_type_id, 24185) IN (24062, 21001) AND 1 - sale / gross < 0.05 THEN 1
    WHEN coalesce(reason_type_id, 24185) = 24185 AND 1 - sale / gross >= 0.05 THEN 0 ELSE 2 END AS sale_reason,
  count(*) AS n FROM daily LEFT JOIN reasons USING (action_type_id) GROUP BY ALL"""))
def classify_reason(spark, sf):
    reason = F.col("reason_type_id")
    rows = retail.daily_sales(spark, sf).join(retail.reasons_of_actions(spark, sf), "action_type_id", "left")
    codes = rows.select(
        predicates.classify(reason, predicates.REASON_TYPES, predicates.OTHER_REASON).alias("aum_type_id"),
        baseline.sale_reason(reason, F.col("sale"), F.col("gross"), 0.05).alias("sale_reason"),
    )
    return codes.groupBy("aum_type_id", "sale_reason").agg(F.count("*").alias("n"))


@query(with_entities("daily", """
SELECT whs_id, count(*) - count(disc_loyal) AS missing, round(sum(sale + coalesce(disc_loyal, 0)), 4) AS opsum,
  count(disc_loyal) AS present FROM daily GROUP BY ALL"""))
def null_defaults(spark, sf):
    return retail.daily_sales(spark, sf).groupBy("whs_id").agg(
        F.count(F.when(F.col("disc_loyal").isNull(), 1)).alias("missing"),
        F.round(F.sum(F.col("sale") + F.coalesce("disc_loyal", F.lit(0))), 4).alias("opsum"),
        F.count(F.when(F.col("disc_loyal").isNotNull(), 1)).alias("present"),
    )


@query("""
SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,6)) AS DOUBLE) AS price, CAST(p_retailprice AS FLOAT) AS price_float,
  TRY_CAST(p_name AS INT) AS bad_number, TRY_CAST(split_part(p_brand, '#', 2) AS INT) AS brand_number,
  CAST(p_size AS VARCHAR) AS size_text, CAST('2020-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS DATE) AS day
FROM part""")
def typed_casts(spark, sf):
    day = F.concat(F.lit("2020-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_retailprice").cast(numeric.PRICE).cast("double").alias("price"),
        F.col("p_retailprice").cast("float").alias("price_float"),
        F.col("p_name").try_cast("int").alias("bad_number"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_number"),
        F.col("p_size").cast("string").alias("size_text"),
        day.cast("date").alias("day"),
    )


@query("""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 1096 FROM orders) GROUP BY ALL""")
def trailing_window_from_max(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    recent = filters.trailing_window(orders, "day", 1096)
    return recent.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_snapshot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return filters.latest_snapshot(orders, "o_orderdate").drop("o_orderdate")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


BRAND_NAME = (
    "CASE c_custkey % 5 WHEN 0 THEN c_name || ' ООО' WHEN 1 THEN c_name || ' оао' WHEN 2 THEN 'C' || c_name "
    "WHEN 3 THEN c_name || ' КК' ELSE c_name || ' мк' END"
)


@query(f"""
SELECT c_custkey, replace(replace(replace(replace(translate(lower({BRAND_NAME}), 'c', 'с'),
  ' ооо', ''), ' оао', ''), ' кк', ''), ' мк', '') AS brand FROM customer""")
def normalise_brand(spark, sf):
    named = table(spark, sf, "customer").select("c_custkey", F.expr(BRAND_NAME).alias("name"))
    return named.select("c_custkey", text.normalise_brand(F.col("name")).alias("brand"))


@query("SELECT doc_id, replace(replace(text, '@', ''), '1', 'one') AS replaced FROM documents")
def string_replace(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.replace_all(F.col("text"), {"@": "", "1": "one"}).alias("replaced")
    )


@query("""
SELECT key, CASE WHEN strpos(name, ' ') > 0 THEN substr(name, strpos(name, ' ') + 1) || ' ' || substr(name, 1, strpos(name, ' ') - 1)
  ELSE name || ' ' || substr(name, 1, length(name) - 1) END AS rotated
FROM (SELECT p_partkey AS key, p_name AS name FROM part UNION ALL SELECT -1 - c_custkey, c_name FROM customer)""")
def rotate_first_word(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    people = table(spark, sf, "customer").select((-1 - F.col("c_custkey")).alias("key"), F.col("c_name").alias("name"))
    return parts.unionByName(people).select("key", text.rotate_first_word(F.col("name")).alias("rotated"))


@query("""
SELECT c_custkey, c_name AS object, CASE WHEN c_custkey % 3 > 0 THEN n_name END AS owner,
  CASE WHEN c_custkey % 3 = 2 THEN r_name END AS source,
  concat(CASE WHEN c_custkey % 3 > 0 THEN n_name END, '.', c_name) AS full_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def split_dotted_name(spark, sf):
    kind = F.col("c_custkey") % 3
    dotted = F.concat_ws(".", F.when(kind == 2, F.col("r_name")), F.when(kind > 0, F.col("n_name")), "c_name")
    rows = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", dotted.alias("name"))
    )
    parts = rows.select("c_custkey", *[text.name_part(F.col("name"), i).alias(n) for i, n in enumerate(("object", "owner", "source"), 1)])
    return parts.withColumn("full_name", F.concat_ws("", "owner", F.lit("."), "object"))


@query(r"""
SELECT c_custkey, nullif(regexp_extract(CASE WHEN c_custkey % 4 = 0 THEN 'OU=' || n_name ELSE 'CN=' || c_name || ',OU=' || n_name || ',DC=x' END,
  'CN=([^,]+),', 1), '') AS group_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def regex_extract(spark, sf):
    full = F.concat(F.lit("CN="), "c_name", F.lit(",OU="), "n_name", F.lit(",DC=x"))
    entry = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("OU="), "n_name")).otherwise(full)
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", text.common_name(entry).alias("group_name"))


@query("""
SELECT o_orderkey, (o_custkey - 500) // 10 AS quotient, (o_custkey - 500) % 10 AS remainder,
  pow(2.0::DOUBLE, o_custkey % 20) AS power FROM orders""")
def div_mod(spark, sf):
    n = F.col("o_custkey") - 500
    return table(spark, sf, "orders").select(
        "o_orderkey", numeric.quotient(n, 10).alias("quotient"), (n % 10).alias("remainder"),
        F.pow(F.lit(2.0), F.col("o_custkey") % 20).alias("power"),
    )


@query(with_entities("valid_pairs", f"""
SELECT skidgr, count(*) AS n, round(avg(d), 4) AS mean_discount FROM (
  SELECT d, {DISCOUNT_BIN('d')} AS skidgr FROM (SELECT CAST(CAST(CAST(CAST(scnd_price AS DECIMAL(18,6)) AS DOUBLE)
    / CAST(CAST(frst_price AS DECIMAL(18,6)) AS DOUBLE) - 1 AS DECIMAL(18,6)) AS DOUBLE) AS d FROM valid_pairs))
GROUP BY ALL"""))
def discount_bins(spark, sf):
    disc = numeric.discount(F.col("frst_price"), F.col("scnd_price"))
    rows = elasticity.valid_pairs(retail.price_pairs(spark, sf)).select(disc.alias("disc"))
    return rows.groupBy(numeric.discount_bin(F.col("disc")).alias("skidgr")).agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("disc").cast("double")), 4).alias("mean_discount")
    )


@query("""
SELECT c_custkey, CASE WHEN v > 35 THEN 35 WHEN v < -35 THEN -35 ELSE v END AS clamped,
  CASE WHEN c_acctbal > 200 THEN 200 ELSE c_acctbal END AS capped
FROM (SELECT *, CASE WHEN c_custkey % 10 > 0 THEN c_acctbal / 100 END AS v FROM customer)""")
def clamp(spark, sf):
    v = F.when(F.col("c_custkey") % 10 > 0, F.col("c_acctbal") / 100)
    return table(spark, sf, "customer").select(
        "c_custkey", numeric.clamp(v).alias("clamped"), numeric.cap(F.col("c_acctbal")).alias("capped")
    )


@query("""
SELECT CASE WHEN l_discount = l_tax THEN 0 WHEN l_discount > l_tax THEN 1 ELSE 2 END AS code, count(*) AS n
FROM lineitem GROUP BY ALL""")
def compare_code(spark, sf):
    code = numeric.compare_code(F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, DATE '1900-01-01' + CAST(o_custkey + 40000 - 2 AS INT) AS day FROM orders")
def excel_serial_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.from_serial(F.col("o_custkey") + 40000).alias("day"))


@query("""
SELECT event_id, ts + INTERVAL 1 DAY AS next_day, ts + INTERVAL 1 MINUTE AS next_minute, ts + INTERVAL 1 SECOND AS next_second,
  CAST(ts AS DATE) AS day, strftime(ts + INTERVAL 1 MINUTE, '%H:%M:%S') AS time_of_day FROM events""")
def interval_arithmetic(spark, sf):
    ts = F.col("ts")
    later = ts + F.expr("INTERVAL 1 MINUTE")
    return table(spark, sf, "events").select(
        "event_id", (ts + F.expr("INTERVAL 1 DAY")).alias("next_day"), later.alias("next_minute"),
        (ts + F.expr("INTERVAL 1 SECOND")).alias("next_second"), ts.cast("date").alias("day"),
        F.date_format(later, "HH:mm:ss").alias("time_of_day"),
    )


@query("""
SELECT l_linestatus, l_tax, round(sum(l_discount) / nullif(sum(l_tax), 0), 4) AS ratio FROM lineitem GROUP BY ALL""")
def safe_ratio(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus", "l_tax").agg(
        F.round(F.try_divide(F.sum("l_discount"), F.sum("l_tax")), 4).alias("ratio")
    )


@query("""
SELECT doc_id, array_to_string(list_filter(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''),
  lambda w, i: i % 2 = 1), ' ') AS words FROM documents""")
def every_nth(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.every_nth_word(F.col("text")).alias("words"))


@query(with_entities("days", "SELECT day_id, CAST(month(day_id) AS INT) AS month_number, CAST(day(day_id) AS INT) AS day_month_number FROM days"))
def sequence_rows(spark, sf):
    return retail.calendar(spark, sf)
