"""The star-schema test tables as retail entities.

A supplier is a warehouse, brand and type of a part make an article, a sold line is a
price observation. Entities are lazy; columns that a query does not use are pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfcurve.operators.windows import ranges_of, with_previous

# Part types in alphabetical order.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
LEVEL_IDS = {0: 1, 1: 1000, 2: 2000, 3: 3000}
PERIOD_DAYS, CAMPAIGN_DAYS, CALENDAR_DAYS = 14, 21, 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PEOPLE = "people_id bigint, fio string, city int, sex int, age int"
CITIES = "id int, region_id int, name string"
REGIONS = "id int, district_id int, name string"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a typed dimension of persons."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        key.alias("people_id"), F.col("c_name").alias("fio"), F.col("c_nationkey").alias("city"),
        (key % 2).cast("int").alias("sex"), (key % 60 + 18).cast("int").alias("age"),
    )
    return rows.to(StructType.fromDDL(PEOPLE))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").toDF("id", "name", "region_id")
    return rows.to(StructType.fromDDL(CITIES))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), (F.col("r_regionkey") % 2).alias("district_id"), F.col("r_name").alias("name")
    )
    return rows.to(StructType.fromDDL(REGIONS))


def _type_index() -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type")).cast("int") - 1


def _article_id() -> Column:
    return F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int") * 10 + _type_index()


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("whs_id"),
        F.col("n_regionkey").alias("gs_fo_id"),
        (F.col("s_nationkey") % 3).alias("frmt_id"),
        F.col("s_nationkey").alias("branch_id"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouses of every fourth branch belong to no cluster."""
    return (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_nationkey") % 4 != 0)
        .select(F.col("s_suppkey").alias("whs_id"), (F.col("s_suppkey") % 3 + 1).cast("int").alias("cluster_id"))
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.col("type_index")
    return (
        table(spark, sf_dir, "part")
        .select(_article_id().alias("art_id"), _type_index().alias("type_index"), "p_brand")
        .distinct()
        .select(
            "art_id",
            (index + 1).alias("direction"),
            F.lit(LEVEL_IDS[0]).alias("art_grp_lvl_0_id"),
            (F.floor(index / 4).cast("int") + LEVEL_IDS[1]).alias("art_grp_lvl_1_id"),
            (F.floor(index / 2).cast("int") + LEVEL_IDS[2]).alias("art_grp_lvl_2_id"),
            (index + LEVEL_IDS[3]).alias("art_grp_lvl_3_id"),
            F.col("p_brand").alias("art_grp_2_lvl_1_name"),
        )
    )


def group_levels(articles: DataFrame) -> DataFrame:
    """Group id and its level, for all four levels."""
    levels = F.explode(
        F.array(
            *[
                F.struct(F.col(f"art_grp_lvl_{n}_id").alias("grp_art_id"), F.lit(n).alias("lvl"))
                for n in range(4)
            ]
        )
    )
    return articles.select(levels.alias("g")).select("g.grp_art_id", "g.lvl").distinct()


def _price(line) -> Column:
    """Price of a sold line, whose columns ``line`` gives by their names. Rounded to four digits by floor,
    which every engine computes alike."""
    price = line("l_extendedprice") * (1 - line("l_discount")) / line("l_quantity")
    return F.floor(price * 10000.0 + 0.5).cast("double") / 10000.0


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold lines with their article."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", _article_id().alias("art_id")
    )
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey").select(
        F.col("l_suppkey").alias("whs_id"),
        "art_id",
        F.col("l_shipdate").cast("date").alias("day_id"),
        _price(F.col).alias("price"),
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "p_name",
    )


def price_pairs(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """Every observation with the one before it at the same warehouse and article."""
    # the price is made of these after the lines have moved: it would be one more column of many digits
    carried = ["l_extendedprice", "l_discount", "l_quantity", "l_orderkey", "day_id"]
    keys, order = ["whs_id", "art_id"], ["day_id", "l_orderkey", "l_linenumber", "l_extendedprice"]
    narrow = observations(spark, sf_dir).select(*dict.fromkeys([*keys, *order, *carried]), "l_returnflag", "l_tax")
    if ranges is None:
        ranges = ranges_of(spark, table(spark, sf_dir, "lineitem").count())
    # a scan and a join with its dimension: made twice rather than written on the way to the ranges
    pairs = with_previous(narrow, keys, order, carried, ranges, stored=True).where(F.col("previous").isNotNull())
    # columns of their own: else each filter on the pairs repeats how the row before was found
    before = [F.col("previous")[c].alias(f"previous_{c}") for c in carried]
    prices = [_price(F.col).alias("price"), _price(lambda c: F.col("previous")[c]).alias("previous_price")]
    pairs = pairs.select("*", F.inline(F.array(F.struct(*before, *prices))))

    def side(prefix: str, row: str) -> list[Column]:
        return [
            F.col(f"{row}price").alias(f"{prefix}_price"),
            F.col(f"{row}l_quantity").alias(f"{prefix}_sale_qnty"),
            F.lit(1).alias(f"{prefix}_day_cnt_rest_sales"),
            (F.col(f"{row}l_orderkey") % 5 + 1).alias(f"{prefix}_client_cnt"),
            (F.col(f"{row}l_orderkey") % 3 + 1).alias(f"{prefix}_txn_cnt"),
            F.col(f"{row}day_id").alias(f"{prefix}_begin_dt"),
            F.date_add(f"{row}day_id", PERIOD_DAYS - 1).alias(f"{prefix}_end_dt"),
        ]

    flag = F.col("l_returnflag")
    reason = F.when(flag == "A", 21001).when(flag == "N", 21007).when(flag == "R", 21004)
    return pairs.select(
        "whs_id",
        "art_id",
        F.lit(1).alias("algorithm_type"),
        reason.alias("scnd_reason_type_id"),
        F.lit(None).cast("int").alias("scnd_holiday_id"),
        F.col("l_tax").alias("ssn_coef_sale_txn"),
        *side("frst", "previous_"),
        *side("scnd", ""),
    )


def campaign_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the top discount start a campaign. An order may hold several versions."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("load_dtm")
    )
    day = F.col("day_id")
    return (
        observations(spark, sf_dir)
        .where(F.col("l_discount") == 0.1)
        .join(orders, "l_orderkey")
        .select(
            F.col("l_orderkey").alias("mc_id"),
            F.col("l_partkey").alias("action_id"),
            "art_id",
            F.col("l_linestatus").alias("status_id"),
            day.alias("begin_dt"),
            F.date_add(day, CAMPAIGN_DAYS - 1).alias("end_dt"),
            "load_dtm",
            "l_linenumber",
            "l_extendedprice",
        )
    )


def campaign_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_discount") == 0.1)
        .select(F.col("l_orderkey").alias("mc_id"), F.col("l_suppkey").alias("whs_id"))
        .distinct()
    )


def campaign_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("action_id"), F.col("p_name").alias("name"))


def promo_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines with a high discount open a promotion."""
    return (
        observations(spark, sf_dir)
        .where((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08))
        .select(
            "whs_id",
            "art_id",
            F.lit(1).alias("market_company_id"),
            F.col("day_id").alias("beg_dt"),
            F.date_add("day_id", CALENDAR_DAYS - 1).alias("end_dt"),
        )
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days between the first and the last sale."""
    day = F.col("l_shipdate").cast("date")
    span = table(spark, sf_dir, "lineitem").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day_id"))
    return days.select(
        "day_id", F.month("day_id").alias("month_number"), F.dayofmonth("day_id").alias("day_month_number")
    )


def daily_sales(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Sales and prices per warehouse, article and day; in ``parts`` by their hash, if given."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    code = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    rows = observations(spark, sf_dir)
    return (
        (rows.repartition(parts, "whs_id", "art_id", "day_id") if parts else rows)
        .groupBy("whs_id", "art_id", "day_id")
        .agg(
            F.sum("l_quantity").alias("sales_qnty"),
            F.count("*").cast("double").alias("rest_qnty"),
            F.sum(net).alias("sale"),
            F.sum(F.when(F.col("l_tax") > 0.04, F.col("l_extendedprice") * F.col("l_tax"))).alias("disc_loyal"),
            F.sum(F.when(F.col("l_discount") >= 0.08, F.col("l_quantity"))).alias("disc_ma_qnty"),
            F.max(code).alias("action_type_id"),
            F.sum("l_extendedprice").alias("gross"),
        )
    )


def prices_of_day(daily: DataFrame) -> DataFrame:
    return daily.select(
        "whs_id",
        "art_id",
        "day_id",
        F.try_divide("sale", "sales_qnty").alias("factual_price"),
        F.try_divide("gross", "sales_qnty").alias("regular_price"),
    )


def reasons_of_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action code of a line status and the price reason it stands for."""
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3)
    reason = F.when(flag == "A", 21001).when(flag == "N", 24185).otherwise(21004)
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_returnflag")
        .distinct()
        .select(code.alias("action_type_id"), reason.alias("reason_type_id"))
    )


def article_info(articles: DataFrame) -> DataFrame:
    """Every seventh article is of the special kind, every fifth is not listed."""
    listed = articles.where(F.col("art_id") % 5 != 0)
    return listed.select("art_id", F.when(F.col("art_id") % 7 == 0, 1).otherwise(0).alias("is_sp_gm"))


def factor_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format, branch, cluster and article group of everything that is sold."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), (_type_index() + LEVEL_IDS[3]).alias("art_grp_lvl_3_id")
    )
    sold = (
        table(spark, sf_dir, "lineitem")
        .join(part, "l_partkey")
        .select(F.col("l_suppkey").alias("whs_id"), "art_grp_lvl_3_id")
        .distinct()
    )
    return (
        sold.join(warehouses(spark, sf_dir), "whs_id")
        .join(clusters(spark, sf_dir), "whs_id", "left")
        .select(
            "frmt_id", "branch_id", F.coalesce("cluster_id", F.lit(1)).alias("cluster_id"), "art_grp_lvl_3_id"
        )
        .distinct()
    )


def season_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log factor per month from order values, for every day of the year."""
    orders = table(spark, sf_dir, "orders").select("o_totalprice", F.month("o_orderdate").alias("month_number"))
    overall = orders.agg(F.avg("o_totalprice")).scalar()
    months = (
        orders.groupBy("month_number")
        .agg(F.avg("o_totalprice").alias("mean_price"))
        .select("month_number", F.ln(F.col("mean_price") / overall).alias("koef_yearly"))
    )
    groups = factor_groups(spark, sf_dir).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month_number")
    )
    days = F.explode(F.sequence(F.lit(1), F.lit(31)))
    return (
        groups.join(months, "month_number")
        .select("*", days.alias("day_number"))
        .select(
            "frmt_id", "branch_id", "cluster_id", "art_grp_lvl_3_id",
            (F.col("month_number") * 100 + F.col("day_number")).alias("yearday_id"),
            (F.col("koef_yearly") + (F.col("branch_id") % 5) * -0.2).alias("koef_yearly"),
        )
    )


def holiday_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant log factor on the first of each month, a second one each January."""
    day = F.col("l_shipdate").cast("date")
    sold = table(spark, sf_dir, "lineitem")
    first = sold.agg(F.trunc(F.min(day), "month")).scalar()
    last = sold.agg(F.max(day)).scalar()
    days = factor_groups(spark, sf_dir).withColumn("days", F.sequence(first, last, F.expr("interval 1 month")))
    january = F.array(F.lit(0.25), F.lit(-0.1))
    factors = F.when(F.month("day_id") == 1, january).otherwise(F.array(F.lit(0.25)))
    return (
        days.withColumn("day_id", F.explode("days"))
        .drop("days")
        .withColumn("koeff_holiday", F.explode(factors))
    )
