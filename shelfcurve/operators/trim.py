"""Iterative sigma trimming of many levels at once, from blocks of sorted values.

The rows of a pass are those inside the band of the pass before, whether or not they were inside an
earlier one; so a pass needs the bands only. The values of each finest key are sorted once and cut
into blocks with their number, mean, sum of squared deviations, least and greatest value; equal
values are counted first and sorted as one. A level is a way to give blocks to groups; copies are made
of blocks, without their values, never of rows.

Without a band a group merges the moments of its blocks. With one, blocks inside the band count with
their moments, blocks outside not at all, and only a block that the band's ends cut is looked into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcurve.operators.joins import copies_per_salt, deal_over_salts, heavy_groups, join_group_stats
from shelfcurve.operators.windows import RANGE, ordered_ranges
from shelfcurve.session import discard, materialise, materialise_buckets

SIGMAS = (3.0, 2.5, 2.0, 2.0)  # fixed values: width of the band in each pass
DIGITS = 6  # fixed value: digits of the band's bounds
BLOCK = 256


def in_band(value: str) -> Column:
    """True inside the band; a missing bound or value is outside."""
    inside = F.col(value).between(F.col(f"{value}_lo"), F.col(f"{value}_hi"))
    return F.coalesce(inside, F.lit(False))


def value_blocks(df: DataFrame, keys: list[str], values: list[str], carried: Column | None = None, block: int = BLOCK) -> DataFrame:
    """Stored blocks of the sorted values of each key, NULL being a key; NULL values are left out.

    ``carried`` is summed along. The values are cut into ranges of (key, value), so a key may have any
    number of them. Blocks lie in hash buckets of their ids: a pass that looks into some of them moves
    the ids, not the values.
    """
    items = F.array(*[F.struct(F.lit(v).alias("_metric"), F.col(v).cast("double").alias("_value")) for v in values])
    more = F.lit(0.0) if carried is None else carried.cast("double")
    long = df.select(F.struct(*keys).alias("_fine"), more.alias("_carried"), F.inline(items)).where("_value IS NOT NULL")
    counted = long.groupBy("_fine", "_metric", "_value").agg(F.count("*").alias("_count"), F.sum("_carried").alias("_carried"))
    ranged = ordered_ranges(counted, ["_fine", "_metric", "_value"])
    place = F.row_number().over(Window.partitionBy("_fine", "_metric", *RANGE).orderBy("_value"))
    cut = ranged.withColumn("_part", F.floor((place - 1) / block))
    made = cut.groupBy("_fine", "_metric", *RANGE, "_part").agg(
        F.sum("_count").alias("_n"), (F.sum(F.col("_value") * F.col("_count")) / F.sum("_count")).alias("_mean"),
        F.min("_value").alias("_least"), F.max("_value").alias("_most"), F.sum("_carried").alias("_total"),
        F.collect_list(F.struct("_value", "_count", "_carried")).alias("_values"),
    )

    def apart(acc: Column, x: Column) -> Column:
        return acc + x["_count"] * (x["_value"] - F.col("_mean")) * (x["_value"] - F.col("_mean"))

    named = made.drop(*RANGE, "_part").withColumn("_m2", F.aggregate("_values", F.lit(0.0), apart))
    numbered = materialise(named.withColumn("_block", F.monotonically_increasing_id()), "numbered")
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialise_buckets(numbered.repartition(buckets, "_block"), "_block", buckets, "blocks", plain=True)
    discard(numbered)
    return blocks


@dataclass(frozen=True)
class Levels:
    """Blocks given to groups: ``dealt`` has a row per block and group, spread by the groups' sizes."""

    blocks: DataFrame
    dealt: DataFrame
    salts: DataFrame


def levels_of(blocks: DataFrame, keys: list[str], spread: Callable[[DataFrame], DataFrame] | None = None) -> Levels:
    """``spread`` copies rows with the columns of the finest key to the groups of all levels, whose
    columns are ``keys``; without it the finest keys are the groups. A NULL in a group's key is no group."""
    narrow = blocks.select("_fine.*", "_metric", "_block", "_n", "_mean", "_m2", "_least", "_most", "_total")
    copied = (spread(narrow) if spread else narrow).dropna("any", subset=keys)
    group = F.struct(*keys, "_metric").alias("_group_key")
    given = copied.select(group, "_block", "_n", "_mean", "_m2", "_least", "_most", "_total")
    given = materialise(given, "levels", plain=True)
    salts = materialise(heavy_groups(given, ["_group_key"]), "salts")
    return Levels(blocks, deal_over_salts(given, ["_group_key"], salts), salts)


def _around(centre: Column) -> list[Column]:
    """Number, and first and second moment about ``centre``, of blocks."""
    apart = F.col("_mean") - centre
    return [F.col("_n").alias("n"), (F.col("_n") * apart).alias("s1"), (F.col("_m2") + F.col("_n") * apart * apart).alias("s2"), F.col("_total").alias("total")]


def _summed(parts: DataFrame) -> DataFrame:
    """(_group_key, n, mean, sd, carried) of parts with moments about their group's ``c``."""
    sums = parts.groupBy("_group_key").agg(*[F.sum(x).alias(x) for x in ("n", "s1", "s2", "total")], F.first("c").alias("c"))
    off = F.col("s1") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("s2") / F.col("n") - off * off, F.lit(0.0)))
    return sums.select("_group_key", "n", (F.col("c") + off).alias("mean"), spread.alias("sd"), (F.col("total") / F.col("n")).alias("carried"))


def open_stats(levels: Levels) -> DataFrame:
    """The statistics of each group over all its values: means first, then the moments about them."""
    means = levels.dealt.groupBy("_group_key").agg((F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("c"))
    met = levels.dealt.join(copies_per_salt(means, ["_group_key"], levels.salts), ["_group_key", "_salt"])
    return _summed(met.select("_group_key", "c", *_around(F.col("c"))))


def band_stats(levels: Levels, bands: DataFrame) -> DataFrame:
    """The statistics of each group over its values inside its band (_group_key, lo, hi); groups
    without such values are left out."""
    centred = bands.where("lo <= hi").withColumn("c", (F.col("lo") + F.col("hi")) / 2)
    met = levels.dealt.join(copies_per_salt(centred, ["_group_key"], levels.salts), ["_group_key", "_salt"])
    met = met.where("_most >= lo AND _least <= hi")
    inside = (F.col("_least") >= F.col("lo")) & (F.col("_most") <= F.col("hi"))
    whole = met.where(inside).select("_group_key", "c", *_around(F.col("c")))
    # a sorted run of values has two blocks at most that an end of the band cuts
    cut = met.where(~inside).select("_group_key", "_block", "lo", "hi", "c").join(levels.blocks.select("_block", "_values"), "_block")
    each = cut.select("_group_key", "c", F.filter("_values", lambda x: x["_value"].between(F.col("lo"), F.col("hi"))).alias("x"), "_block")
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), *[F.lit(0.0).alias(n) for n in ("s1", "s2", "total")])

    def add(acc: Column, x: Column) -> Column:
        apart, n = x["_value"] - F.col("c"), x["_count"]
        return F.struct(
            (acc["n"] + n).alias("n"), (acc["s1"] + n * apart).alias("s1"), (acc["s2"] + n * apart * apart).alias("s2"),
            (acc["total"] + x["_carried"]).alias("total"),
        )

    looked = each.where(F.size("x") > 0).select("_group_key", "c", F.aggregate("x", zero, add).alias("m"))
    return _summed(whole.unionByName(looked.select("_group_key", "c", "m.*")))


def trim_bands(levels: Levels, sigmas: Sequence[float] = SIGMAS) -> DataFrame:
    """(_group_key, lo, hi): the last band of each group. A group that has no value left has none.

    The bands of a pass are written: they are tiny next to the blocks, and their real size lets the
    planner broadcast them or not.
    """
    bands = None
    for width in sigmas:
        stats = open_stats(levels) if bands is None else band_stats(levels, bands)
        reach = F.col("sd") * width
        bound = lambda x: F.round(x, DIGITS)
        bands = stats.select("_group_key", bound(F.col("mean") - reach).alias("lo"), bound(F.col("mean") + reach).alias("hi"))
        bands = materialise(bands, "bands", plain=True)
    return bands


def sigma_trim(df: DataFrame, keys: list[str], values: list[str], sigmas: Sequence[float] = SIGMAS, block: int = BLOCK) -> DataFrame:
    """Rows with a flag ``flag_<value>`` that tells whether the last pass keeps the value.

    Rows with a NULL key are left out. Hand over a stored table: it is read for the blocks and for
    the flags.
    """
    bands = trim_bands(levels_of(value_blocks(df, keys, values, block=block), keys), sigmas)
    ends = [F.max(F.when(F.col("_metric") == v, F.col(end))).alias(f"{v}_{end}") for v in values for end in ("lo", "hi")]
    wide = bands.select("_group_key.*", "lo", "hi").groupBy(*keys).agg(*ends)
    every = df.select(*keys).dropna("any").distinct().join(wide, keys, "left")
    flagged = join_group_stats(df, materialise(every, "ends", plain=True), keys)
    flagged = flagged.withColumns({f"flag_{v}": in_band(v).cast("int") for v in values})
    return flagged.select(*df.columns, *[f"flag_{v}" for v in values])
