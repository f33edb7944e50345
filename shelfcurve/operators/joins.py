"""Joins that Catalyst does not derive by itself: all are written as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcurve.functions.dates import overlap_share
from shelfcurve.functions.predicates import all_of
from shelfcurve.session import materialise


def semi_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left semi-join on columns of the same names, where NULL equals NULL."""
    other = right.select(*[F.col(c).alias(f"o_{c}") for c in on])
    return left.join(other, all_of(F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in on), "left_semi")


def left_with_defaults(left: DataFrame, right: DataFrame, on: list[str], defaults: dict) -> DataFrame:
    """Left join; missing values of the right side get a default."""
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


ROWS_PER_SALT = 1_000_000
HITTERS = 1_000  # groups that may get salts, and ten times as many counters in the sketch


def heavy_groups(rows: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(_group, _salts): by the hash of their keys the large groups, with salts in proportion to their
    rows, from a sketch of heavy hitters. At most ``HITTERS`` rows; all other groups keep one salt."""
    tracked = f"approx_top_k(_group, {HITTERS}, {10 * HITTERS})"
    top = rows.select(F.xxhash64(*keys).alias("_group")).agg(F.expr(tracked).alias("t")).select(F.explode("t").alias("t"))
    wanted = F.ceil(F.col("t.count") / rows_per_salt).cast("int")
    return top.select(F.col("t.item").alias("_group"), wanted.alias("_salts")).where("_salts > 1")


def deal_over_salts(rows: DataFrame, keys: list[str], salts: DataFrame) -> DataFrame:
    """``rows`` with ``_salt``. It comes from a row's values and its partition, so equal rows spread too
    and a task that runs again deals them alike."""
    # at most HITTERS rows in the broadcast
    known = rows.withColumn("_group", F.xxhash64(*keys)).join(F.broadcast(salts), "_group", "left")
    salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.coalesce("_salts", F.lit(1)))
    return known.select(*rows.columns, salt.cast("int").alias("_salt"))


def copies_per_salt(stats: DataFrame, keys: list[str], salts: DataFrame) -> DataFrame:
    """One copy of a group's row per salt of the group, with ``_salt``."""
    known = stats.withColumn("_group", F.xxhash64(*keys)).join(F.broadcast(salts), "_group", "left")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    return known.withColumn("_salt", each).drop("_group", "_salts")


def join_group_stats(rows: DataFrame, stats: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Inner join of rows with one row of statistics per group; NULL keys do not match.

    The rows of a large group are dealt over salts and its statistics repeated once per salt, so a
    group spreads over as many tasks as other rows of that number. ``rows`` is read twice, for the
    sizes of its groups and for the join: hand over a stored table.
    """
    salts = heavy_groups(rows, keys, rows_per_salt)
    values = [c for c in stats.columns if c not in keys]
    return deal_over_salts(rows, keys, salts).join(copies_per_salt(stats, keys, salts), [*keys, "_salt"]).select(*rows.columns, *values)


def longest_per_begin(intervals: DataFrame, keys: list[str], begin: str, end: str) -> DataFrame:
    """Of the intervals with the same begin keep the longest.

    It contains the others, so neither the covered days nor the best overlap change. At
    most one interval per key and day is left, whatever the number of rows.
    """
    valid = intervals.where(F.col(begin) <= F.col(end))
    return valid.groupBy(*keys, begin).agg(F.max(end).alias(end))


def interval_days(
    intervals: DataFrame, keys: list[str], begin: str, end: str, first=None, last=None, day: str = "day_id"
) -> DataFrame:
    """Distinct days that any interval of a key covers, within ``first`` and ``last``.

    Each interval gives only the days after the greatest end before it, so a day is made once. A key
    has one interval per begin at most, which bounds its window by the number of days.
    """
    lo = F.col(begin) if first is None else F.greatest(F.col(begin), first)
    hi = F.col(end) if last is None else F.least(F.col(end), last)
    reduced = longest_per_begin(intervals.select(*keys, lo.alias("lo"), hi.alias("hi")), keys, "lo", "hi")
    earlier = Window.partitionBy(*keys).orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    reached = reduced.withColumn("lo", F.greatest("lo", F.date_add(F.max("hi").over(earlier), 1)))
    return reached.where("lo <= hi").select(*keys, F.explode(F.sequence("lo", "hi")).alias(day))


FINEST, STEP, TOP = 5, 3, 4  # bins of 2**5 days at level 0, eight times as long at each next one up to 4


def _level(begin: str, end: str) -> str:
    """The finest level whose bins are as long as the interval, which so touches two of them at most."""
    days = f"datediff({end}, {begin}) + 1"
    cases = " ".join(f"WHEN {days} <= {1 << FINEST + STEP * k} THEN {k}" for k in range(TOP))
    return f"CASE {cases} ELSE {TOP} END"


def bins(df: DataFrame, begin: str, end: str, met: Column, own: int) -> DataFrame:
    """An interval's bins: those of its own level, and those at each higher level in the set of bits
    ``met``. Kind ``own`` are bins of the own level, the other kind those above.

    Of two intervals the one of the finer level meets the other in the bins of the other's level, so
    a join by (kind, lvl, bin) finds each overlap, with at most two rows per interval, level and kind.
    """
    # equal levels meet once: as own bins of side 0 and as bins of both kinds of side 1
    kinds = f"if(k = _level, array({'0' if own == 0 else '0, 1'}), array({1 - own}))"
    of = lambda day: f"shiftright(datediff({day}, DATE '1970-01-01'), {FINEST} + {STEP} * k)"
    each = f"flatten(transform({kinds}, n -> transform(sequence({of(begin)}, {of(end)}), b -> struct(n AS kind, k AS lvl, b AS bin))))"
    levels = f"filter(sequence(_level, {TOP}), k -> k = _level OR getbit(_met, k) = 1)"
    valid = df.where(F.col(begin) <= F.col(end)).withColumns({"_level": F.expr(_level(begin, end)), "_met": met})
    return valid.select("*", F.expr(f"inline(flatten(transform({levels}, k -> {each})))")).drop("_level", "_met")


def overlapped(
    events: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    event: tuple[str, str],
    interval: tuple[str, str],
    min_share: float,
    labels: list[str] = (),
) -> DataFrame:
    """Distinct event intervals of which one interval covers at least ``min_share``.

    Both sides are put into bins of days whose length suits theirs, so only intervals close in time meet
    and a long one needs no more rows than a short one. The semi-join stops at the first interval that
    is enough; pairs are never written out. ``events`` is read twice, for the levels that occur and for
    the bins. Columns of the result: keys, ``labels`` of the event, its begin and its end.
    """

    def met(df: DataFrame, begin: str, end: str) -> Column:
        bits = F.bit_or(F.expr(f"shiftleft(1, {_level(begin, end)})"))
        return F.coalesce(df.where(F.col(begin) <= F.col(end)).agg(bits).scalar(), F.lit(0))

    spans = events.select(*keys, *labels, F.col(event[0]).alias("eb"), F.col(event[1]).alias("ee"))
    others = longest_per_begin(intervals, keys, *interval).select(
        *[F.col(k).alias(f"i_{k}") for k in keys], F.col(interval[0]).alias("ib"), F.col(interval[1]).alias("ie")
    )
    others = materialise(others, "intervals", plain=True)
    left = bins(spans, "eb", "ee", met(others, "ib", "ie"), 0)
    right = bins(others, "ib", "ie", met(spans, "eb", "ee"), 1).withColumnsRenamed({c: f"i_{c}" for c in ("kind", "lvl", "bin")})
    near = all_of(F.col(k) == F.col(f"i_{k}") for k in [*keys, "kind", "lvl", "bin"])
    enough = overlap_share(F.col("eb"), F.col("ee"), F.col("ib"), F.col("ie")) >= min_share
    common = (F.col("ib") <= F.col("ee")) & (F.col("ie") >= F.col("eb"))
    # the planner does not see that bins multiply the intervals, and would broadcast what is too large for it
    hits = left.join(right.hint("merge"), near & common & enough, "left_semi")
    return hits.select(*keys, *labels, F.col("eb").alias(event[0]), F.col("ee").alias(event[1])).distinct()


def match_hierarchy(
    articles: DataFrame, groups: DataFrame, article: str, levels: dict[int, str], brand: str, any_brand: str = "-1"
) -> DataFrame:
    """Match an article to groups at each of its levels, by its brand or by "any brand".

    ``groups`` has the columns art_grp_lvl, grp_art_id and brand. The article is unpivoted
    to one row per level and brand, which leaves an equi-join on three columns.
    """
    pairs = F.array(
        *[F.struct(F.lit(n).alias("art_grp_lvl"), F.col(c).alias("grp_art_id")) for n, c in levels.items()]
    )
    # array_distinct: an article whose own brand is the sentinel must not match twice
    brands = F.array_distinct(F.array(F.col(brand), F.lit(any_brand)))
    keys = articles.select(article, brands.alias("brands"), F.inline(pairs)).select(
        article, "art_grp_lvl", "grp_art_id", F.explode("brands").alias("brand")
    )
    return keys.join(groups, ["art_grp_lvl", "grp_art_id", "brand"])


def lookup_with_fallback(
    df: DataFrame, specific: DataFrame, generic: DataFrame, on: list[str], generic_on: list[str], values: list[str]
) -> DataFrame:
    """Value from the specific row, else from the generic row, else NULL."""
    spec = specific.select(*on, *[F.col(v).alias(f"{v}_specific") for v in values])
    gen = generic.select(*generic_on, *[F.col(v).alias(f"{v}_generic") for v in values])
    joined = df.join(spec, on, "left").join(gen, generic_on, "left")
    merged = {v: F.coalesce(f"{v}_specific", f"{v}_generic") for v in values}
    extra = [f"{v}_{side}" for v in values for side in ("specific", "generic")]
    return joined.withColumns(merged).drop(*extra)


def merge_ordered(a: DataFrame, b: DataFrame, order: list[str]) -> DataFrame:
    """Rows of both tables in one order; the sort is spread over ranges."""
    return a.unionByName(b).orderBy(*order)
