"""Ordered operators. A long key, like a whole table, is cut into ranges of its order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcurve.functions.predicates import all_of
from shelfcurve.operators.joins import join_group_stats
from shelfcurve.session import discard, materialise, materialise_buckets


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key in a total order.

    Spark limits each group before the shuffle (WindowGroupLimit), so a hot key moves one
    row per task only.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """All rows that share the best place of their key: ties are kept, NULL keys are a key.

    The best place of a key is an aggregate with map-side combine; the rows meet it again in a
    join whose large groups are split, so the ties of a key may be any number of rows.
    """
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    placed = materialise(df.withColumns({"_key": F.struct(*keys), "_place": place}), "placed")
    best = placed.groupBy("_key").agg(F.min("_place").alias("_place"))
    return join_group_stats(placed, best, ["_key", "_place"]).select(*df.columns)


ROWS_PER_RANGE = 1_000_000


def ranges_of(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))


def ordered_ranges(df: DataFrame, order: list[str], ranges: int | None = None, stored: bool = False) -> DataFrame:
    """Cut a table into ranges of a total order, numbered by ``_range``, and store it in buckets of them.

    The rows are written first, so the bounds are sampled from the stored columns of the order and
    ``df`` runs once. After the one exchange into ranges, whatever is partitioned by ``RANGE`` reads
    its bucket as it is. Without ``ranges`` their number follows the rows. ``stored`` says that ``df``
    is little more than a scan of a table, which need not be written first.
    """
    spark = df.sparkSession
    rows = df if stored else materialise(df, "unordered")
    if ranges is None:
        ranges = ranges_of(spark, rows.count())
    # a label per range, chosen so that the ranges fall into different buckets
    label = spark.range(24 * ranges).groupBy(F.pmod(F.hash("id"), F.lit(ranges)).alias("_range")).agg(F.min("id").alias("_bucket"))
    ranged = rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    # one row per range in the broadcast
    labelled = ranged.join(F.broadcast(label), "_range", "left").withColumn("_bucket", F.coalesce("_bucket", F.col("_range").cast("bigint")))
    made = materialise_buckets(labelled, "_bucket", ranges, "ranges")
    if not stored:
        discard(rows)
    return made


RANGE = ["_bucket", "_range"]


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], ranges: int | None = None, stored: bool = False
) -> DataFrame:
    """Add ``previous``: the given columns of the row before, per key.

    The rows are cut into ranges of (keys, order). Inside a range the row before is at hand;
    the first row of a range may follow the last row of the range before, which comes from a
    table with one row per range. A key, or a day of a key, may span any number of ranges.
    """
    ranged = ordered_ranges(df, [*keys, *order], ranges, stored)
    row = F.struct(*columns)
    whole = F.struct(*[F.col(k).alias(f"_last_{k}") for k in keys], row.alias("_carried"))
    # the greatest first key is cheap to find, so only its rows are compared by the whole order
    top = F.broadcast(ranged.groupBy(*RANGE).agg(F.max(keys[0]).alias("_top")))
    ends = ranged.join(top, RANGE).where(F.col(keys[0]).eqNullSafe(F.col("_top")))
    lasts = ends.groupBy(*RANGE).agg(F.max_by(whole, F.struct(*keys, *order)).alias("_last"))
    # one row per range in this window and in the broadcasts
    before = lasts.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_before"))
    # the sort compares its first column cheaply, and the range is the same in all rows of a task
    inside = F.lag(row).over(Window.partitionBy(*keys, *RANGE).orderBy(*order))
    same = all_of(F.col(k).eqNullSafe(F.col(f"_before._last_{k}")) for k in keys)
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(before), "_range")
        .withColumn("previous", F.coalesce("_inside", F.when(same, F.col("_before._carried"))))
        .drop(*RANGE, "_inside", "_before")
    )


def running_total(
    df: DataFrame, order: list[str], value: str, total: str = "running_total", ranges: int | None = None
) -> DataFrame:
    """Running sum over a whole table in a total order.

    Each range sums its own rows; the sum of the ranges before comes from a table with one
    row per range.
    """
    ranged = ordered_ranges(df, order, ranges)
    sums = ranged.groupBy(*RANGE).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per range
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(total, F.sum(value).over(inside) + F.col("_offset"))
        .drop(*RANGE, "_offset")
    )


def surrogate_key(df: DataFrame, order: list[str], name: str = "id", ranges: int | None = None) -> DataFrame:
    """Dense row numbers from 1 in a total order."""
    return running_total(df.withColumn("_one", F.lit(1).cast("bigint")), order, "_one", name, ranges).drop("_one")


def span_filter(df: DataFrame, keys: list[str], value: str, more_than: int, span_over: float) -> DataFrame:
    """Groups with more than ``more_than`` rows and a spread of ``value`` over ``span_over``.

    Meant for bins, of which a group has few: one window reads the input once.
    """
    group = Window.partitionBy(*keys)
    spread = F.max(value).over(group) - F.min(value).over(group)
    measured = df.withColumns({"_n": F.count("*").over(group), "_span": spread})
    return measured.where((F.col("_n") > more_than) & (F.col("_span") > span_over)).drop("_n", "_span")


def change_between_snapshots(snapshots: DataFrame, table: str, taken: str, rows: str) -> DataFrame:
    """Change of the row count between successive snapshots; NULL for the first of a table."""
    previous = F.lag(rows).over(Window.partitionBy(table).orderBy(taken))
    return snapshots.withColumn("change", F.col(rows) - previous)
