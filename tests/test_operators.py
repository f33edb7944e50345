import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfcurve.operators import aggregates, filters, joins, levels, quality, reshape, trim, upsert, windows

D = datetime.date


def day(n):
    return D(2024, 1, 1) + datetime.timedelta(days=n)


# --- trimming -------------------------------------------------------------------------


def flags_row_by_row(data, sigmas):
    """Trimming as flags on rows, group by group."""
    groups = {}
    for key, value in data:
        groups.setdefault(key, []).append(value)
    kept = {}
    for key, vals in groups.items():
        flags = [v is not None for v in vals]
        for width in sigmas:
            inside = [v for v, f in zip(vals, flags) if f]
            if not inside:
                flags = [False] * len(vals)
                continue
            mean = sum(inside) / len(inside)
            sd = (sum((v - mean) ** 2 for v in inside) / len(inside)) ** 0.5
            lo, hi = round(mean - width * sd, 6), round(mean + width * sd, 6)
            flags = [v is not None and lo <= v <= hi for v in vals]
        kept[key] = sorted(v for v, f in zip(vals, flags) if f)
    return kept


def trimmed(spark, data, sigmas=trim.SIGMAS, **kw):
    df = spark.createDataFrame(data, "k string, v double")
    kept = {k: [] for k, _ in data if k is not None}
    for r in trim.sigma_trim(df, ["k"], ["v"], sigmas, **kw).where("flag_v = 1").collect():
        kept[r.k].append(r.v)
    return {k: sorted(v) for k, v in kept.items()}


def test_sigma_trim_equals_row_by_row_flags(spark):
    rng = random.Random(7)
    data = [("g0" if i % 3 else f"g{i % 9}", round(rng.paretovariate(1.3), 4)) for i in range(900)]
    data += [("n", None), ("n", 1.0), ("n", 1.5)]
    assert trimmed(spark, data) == flags_row_by_row(data, trim.SIGMAS)


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_blocks_of_any_size_give_the_same_flags(spark, block):
    """One key over several ranges, equal values over the ends of blocks, values of very different size."""
    rng = random.Random(8)
    data = [("hot" if i % 4 else f"k{i % 12}", rng.choice([1.0, 1.0, 2.5, 1e6, round(rng.gauss(0, 3), 5)])) for i in range(1500)]
    assert trimmed(spark, data, block=block) == flags_row_by_row(data, trim.SIGMAS)


def test_levels_are_trimmed_without_copies_of_rows(spark):
    """Each level is trimmed as if it were alone; what is copied to the levels are blocks."""
    rng = random.Random(9)
    data = [(rng.randrange(3), rng.randrange(2), round(rng.paretovariate(1.5), 4)) for _ in range(3000)]
    df = spark.createDataFrame(data, "a int, b int, v double")
    blocks = trim.value_blocks(df, ["a", "b"], ["v"])
    assert blocks.count() < 3000 / 50
    found = trim.levels_of(blocks, ["level_mask", "a", "b"], lambda x: levels.masked_levels(x, {"a": F.lit(-1), "b": F.lit(-1)}))
    assert found.dealt.count() == 4 * blocks.count()
    kept = {tuple(r[:3]): r.n for r in trim.band_stats(found, trim.trim_bands(found)).select("_group_key.*", "n").drop("_metric").collect()}
    rows = [((m, a if m & 1 else -1, b if m & 2 else -1), v) for a, b, v in data for m in range(4)]
    assert kept == {k: len(v) for k, v in flags_row_by_row(rows, trim.SIGMAS).items()}


def test_equal_values_are_one_value_of_a_block(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 6 / 4).alias("v"))
    blocks = trim.value_blocks(df, ["k"], ["v"])
    assert tuple(blocks.agg(F.sum(F.size("_values")), F.sum("_n")).first()) == (6, 60_000)
    stats = trim.open_stats(trim.levels_of(blocks, ["k"])).select("_group_key.k", "n", "mean", "sd").orderBy("k").collect()
    assert [r[:2] for r in stats] == [(0, 30_000), (1, 30_000)]
    assert [x for r in stats for x in r[2:]] == pytest.approx([0.5, 6**-0.5, 0.75, 6**-0.5])


def test_a_row_can_come_back(spark):
    # one narrow pass drops the outer values, the next wide pass takes them in again
    data = [("g", v) for v in (0.0, 1.0, 2.0, 3.0, 4.0)]
    assert trimmed(spark, data, (0.8,))["g"] == [1.0, 2.0, 3.0]
    assert trimmed(spark, data, (0.8, 3.0))["g"] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_a_single_row_survives_only_the_rounding(spark):
    assert trimmed(spark, [("a", 0.25), ("b", 0.12345678)]) == {"a": [0.25], "b": []}


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 1.0)], "k string, v double")
    assert [r.k for r in trim.sigma_trim(df, ["k"], ["v"]).collect()] == ["a"]


def test_wide_bands_drop_nothing(spark):
    data = [("g", float(v)) for v in range(50)]
    assert trimmed(spark, data, (1000.0,) * 4)["g"] == [float(v) for v in range(50)]


# --- fit and gates --------------------------------------------------------------------

POINT = "g int, skidgr bigint, prir double, n bigint, av_disc double, stddev_koeff double, cnt_int_rows bigint"


def fitted(spark, points):
    df = spark.createDataFrame(points, POINT)
    x = F.col("skidgr") / 1000.0
    return aggregates.weighted_log_fit(df, ["g"], x, F.col("prir"), F.col("n")).first()


@pytest.mark.parametrize("counts", [(3, 5, 9, 14), (20, 100, 30000, 15000)])
def test_fit_recovers_exact_data(spark, counts):
    import math

    a, b = 0.3, 1.7
    points = [
        (1, -100 * i, math.exp(a + b * i / 10) - 1, n, -i / 10, 0.1, n) for i, n in enumerate(counts, 1)
    ]
    row = fitted(spark, points)
    assert (row.exp_trend_a, row.exp_trend_b) == (pytest.approx(a), pytest.approx(b))
    assert (row.disc_group_cnt, row.sum_cnt_int_rows) == (4, sum(counts))


@pytest.mark.parametrize("counts", [(3, 5, 9, 14), (20, 100, 30000, 16000)])
def test_fit_weights_match_the_scaled_ones(spark, counts):
    import math

    ys = [0.2, 0.9, 0.4, 1.3]
    points = [(1, -100 * i, math.exp(y) - 1, n, 0.0, 0.1, n) for i, (y, n) in enumerate(zip(ys, counts), 1)]
    top = max(counts)
    w = [min(1, n / 15000) if top >= 15 else n / min(top, 15000) for n in counts]
    x = [-i / 10 for i in range(1, 5)]
    s = lambda *c: sum(math.prod(v) for v in zip(*c))
    b = -(s(w, x, ys) * s(w) - s(w, ys) * s(w, x)) / (s(w, x, x) * s(w) - s(w, x) ** 2)
    a = (b * s(w, x) + s(w, ys)) / s(w)
    row = fitted(spark, points)
    assert (row.exp_trend_a, row.exp_trend_b) == (pytest.approx(a), pytest.approx(b))


def test_fit_without_slope_is_null(spark):
    row = fitted(spark, [(1, -100, 0.5, 10, 0.0, 0.1, 10), (1, -100, 0.7, 10, 0.0, 0.1, 10)])
    assert row.exp_trend_a is None and row.exp_trend_b is None


def test_quality_gate(rows, values):
    df = rows(
        "g int, sd double, m double, n int",
        (1, 0.4, 0.0, 10), (2, 0.5, 0.0, 10), (3, 0.5, 0.0, 200), (4, 0.1, 0.0, 9), (5, 0.4999999, 0.0, 50),
    )
    kept = aggregates.quality_gate(df, "sd", "m", "n")
    assert [r[0] for r in values(kept)] == [1, 3]  # 0.4999999 rounds to 0.5


def test_span_filter(rows, values):
    df = rows("g int, x int", *[(1, i * 70) for i in range(4)], *[(2, i * 50) for i in range(4)], *[(3, i * 200) for i in range(3)])
    assert {r[0] for r in values(windows.span_filter(df, ["g"], "x", 3, 200))} == {1}


# --- joins ----------------------------------------------------------------------------


def overlaps(rows, events, intervals, share):
    e = rows("k int, b date, e date", *events)
    i = rows("k int, ib date, ie date", *intervals)
    found = joins.overlapped(e, i, ["k"], ("b", "e"), ("ib", "ie"), share)
    return sorted((r.k, (r.b - day(0)).days, (r.e - day(0)).days) for r in found.collect())


def test_share_of_exactly_the_limit_counts(rows):
    event = (1, day(0), day(9))
    assert overlaps(rows, [event], [(1, day(3), day(30))], 0.7) == [(1, 0, 9)]
    assert overlaps(rows, [event], [(1, day(4), day(30))], 0.7) == []


def test_touching_on_one_day(rows):
    assert overlaps(rows, [(1, day(0), day(0))], [(1, day(0), day(5))], 1.0) == [(1, 0, 0)]
    assert overlaps(rows, [(1, day(0), day(9))], [(1, day(9), day(9))], 0.1) == [(1, 0, 9)]


def test_shares_of_two_intervals_do_not_add_up(rows):
    assert overlaps(rows, [(1, day(0), day(9))], [(1, day(0), day(4)), (1, day(5), day(9))], 0.7) == []


@pytest.mark.parametrize("share", [0.3, 0.7, 1.0])
def test_overlaps_equal_brute_force(rows, share):
    rng = random.Random(5)

    def some(n, keys, length):
        made = []
        for _ in range(n):
            b = rng.randrange(-40, 400)
            made.append((0 if rng.random() < 0.4 else rng.randrange(keys), day(b), day(b + rng.randrange(length))))
        return made

    events, intervals = some(300, 8, 40), some(200, 8, 90)
    expected = set()
    for k, b, e in events:
        for ik, ib, ie in intervals:
            common = (min(e, ie) - max(b, ib)).days + 1
            if k == ik and common > 0 and common / ((e - b).days + 1) >= share:
                expected.add((k, (b - day(0)).days, (e - day(0)).days))
    assert overlaps(rows, events, intervals, share) == sorted(expected)


def test_interval_days_clip_and_merge(rows):
    df = rows("k int, b date, e date", (1, day(0), day(3)), (1, day(2), day(5)), (1, day(0), day(1)), (2, day(9), day(8)))
    found = joins.interval_days(df, ["k"], "b", "e", F.lit(day(1)), F.lit(day(4)))
    assert sorted(r.day_id for r in found.collect()) == [day(i) for i in range(1, 5)]


def test_hierarchy_match_does_not_double_the_sentinel(rows, values):
    arts = rows("art int, l0 int, l1 int, brand string", (1, 10, 20, "x"), (2, 10, 21, "-1"), (3, 11, 21, None))
    groups = rows(
        "art_grp_lvl int, grp_art_id int, brand string, v int",
        (0, 10, "-1", 1), (1, 20, "x", 2), (1, 20, "y", 3), (1, 21, "-1", 4), (0, 20, "x", 5),
    )
    found = joins.match_hierarchy(arts, groups, "art", {0: "l0", 1: "l1"}, "brand")
    assert values(found.select("art", "v")) == [(1, 1), (1, 2), (2, 1), (2, 4), (3, 4)]


def test_lookup_prefers_the_specific_row(rows, values):
    df = rows("a int, f int", (1, 1), (1, 2), (2, 1), (3, 1))
    specific = rows("a int, f int, v int", (1, 1, 10))
    generic = rows("a int, v int", (1, 99), (2, 88))
    found = joins.lookup_with_fallback(df, specific, generic, ["a", "f"], ["a"], ["v"])
    assert values(found.select("a", "f", "v")) == [(1, 1, 10), (1, 2, 99), (2, 1, 88), (3, 1, None)]


@pytest.mark.parametrize("rows_per_salt", [1, 7, 1_000_000])
def test_group_stats_join(spark, values, rows_per_salt):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(60)] + [(None, 99), ("hot", 1)], "k string, v int")
    stats = df.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    got = joins.join_group_stats(df, stats, ["k"], rows_per_salt)
    assert got.columns == ["k", "v", "n", "top"]
    assert values(got) == values(df.join(stats, "k"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("value", ["id", "7"])
def test_group_stats_join_spreads_a_hot_group(spark, no_broadcast, value):
    """Half of the rows are of one group; they spread as those of a uniform table, equal rows too."""
    df = spark.range(0, 40_000, 1, 40).select(F.expr("if(id % 2 = 0, -1, id)").alias("k"), F.expr(value).alias("v"))
    stats = df.groupBy("k").agg(F.count("*").alias("n"))
    got = joins.join_group_stats(df, stats, ["k"], 200)
    sizes = [r["count"] for r in got.where("k = -1").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8


def test_small_groups_get_no_copies(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    stats = df.withColumn("n", F.lit(1)).drop("v")
    assert joins.join_group_stats(df, stats, ["k"]).count() == 1000


def test_a_day_is_made_once_per_key(spark):
    """Nested, touching, disjoint and repeated intervals; NULL keys; a key of very many intervals."""
    rng = random.Random(4)
    data = [("hot" if i % 2 else f"k{i % 9}", day(a := rng.randrange(300)), day(a + rng.randrange(-2, 40))) for i in range(600)]
    data += [(None, day(1), day(3)), ("n", None, day(3)), ("n", day(3), None)]
    days = joins.interval_days(spark.createDataFrame(data, "k string, b date, e date"), ["k"], "b", "e")
    expected = {(k, b + datetime.timedelta(days=n)) for k, b, e in data if b and e for n in range((e - b).days + 1)}
    got = [tuple(r) for r in days.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # printed from the top: nothing is made distinct after the days


def test_overlaps_of_all_lengths(spark):
    rng = random.Random(5)

    def some(n, longest):
        return [(rng.randrange(3), day(a := rng.randrange(-4000, 4000)), day(a + rng.choice([0, 5, 31, 32, 300, 2047, longest]))) for _ in range(n)]

    events, intervals = some(200, 9000), some(60, 12000)
    frames = [spark.createDataFrame(x, "k int, b date, e date") for x in (events, intervals)]
    got = joins.overlapped(*frames, ["k"], ("b", "e"), ("b", "e"), 0.4)

    def share(e, i):
        return ((min(e[2], i[2]) - max(e[1], i[1])).days + 1) / ((e[2] - e[1]).days + 1)

    assert sorted(map(tuple, got.collect())) == sorted({e for e in events if any(e[0] == i[0] and share(e, i) >= 0.4 for i in intervals)})


def test_a_long_interval_has_few_bins(rows):
    df = rows("b date, e date", (day(0), day(365 * 30)), (day(0), day(0)), (day(3), day(2)))
    counts = joins.bins(df, "b", "e", F.lit(31), 1).groupBy("b", "e").count().collect()
    assert len(counts) == 2 and max(r["count"] for r in counts) < 40


# --- windows --------------------------------------------------------------------------


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_previous_row_whatever_the_ranges(spark, ranges):
    """Half of the rows are of one key, and half of those of one day."""
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}", day(rng.choice([7, rng.randrange(60)])), i, i * 1.5) for i in range(400)]
    data += [(None, day(1), 400, 0.5), (None, day(2), 401, None)]
    df = spark.createDataFrame(data, "k string, d date, n int, v double")
    found = windows.with_previous(df, ["k"], ["d", "n"], ["d", "n", "v"], ranges).collect()
    last, expected = {}, {}
    for k, d, n, v in sorted(data, key=lambda r: (r[1], r[2])):
        expected[n], last[k] = last.get(k), (d, n, v)
    assert {r.n: tuple(r.previous) if r.previous else None for r in found} == expected


@pytest.mark.parametrize("ranges", [None, 3, 64])
def test_running_total_equals_plain_sum(spark, ranges):
    rng = random.Random(2)
    data = [(i, rng.randrange(100)) for i in range(1000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "n int, v bigint").repartition(8)
    total, expected = 0, {}
    for n, v in sorted(data):
        total += v
        expected[n] = total
    assert {r.n: r.running_total for r in windows.running_total(df, ["n"], "v", ranges=ranges).collect()} == expected


@pytest.mark.parametrize("ranges", [None, 3, 64])
def test_surrogate_keys_are_dense(spark, ranges):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("n")).repartition(8)
    assert all(r.id == r.n + 1 for r in windows.surrogate_key(df, ["n"], ranges=ranges).collect())


def test_best_per_key_keeps_ties(rows, values):
    df = rows("k int, lvl int, v string", (1, 3, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d"))
    best = windows.best_per_key(df, ["k"], [-F.col("lvl")])
    assert values(best.select("k", "v")) == [(1, "a"), (1, "b"), (2, "d")]


def test_ties_of_a_key_spread(spark, no_broadcast, values, monkeypatch):
    monkeypatch.setattr(joins.join_group_stats, "__defaults__", (200,))
    df = spark.range(0, 20_000, 1, 40).select(F.expr("if(id % 4 > 0, NULL, id)").alias("k"), F.lit(None).cast("int").alias("o"), F.col("id").alias("v"))
    best = windows.best_per_key(df, ["k"], [F.col("o")])
    sizes = [r["count"] for r in best.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 15_000 and len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8


def test_ordered_ranges_need_no_exchange_of_rows(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("n"), F.lit(1).alias("v"))
    plan = windows.running_total(df, ["n"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("SinglePartition") == 1


def test_change_between_snapshots_keeps_all(rows, values):
    df = rows("t string, at int, n bigint", *[("x", i, i * i) for i in range(80)])
    assert values(windows.change_between_snapshots(df, "t", "at", "n").where("at < 4").select("at", "change")) == [
        (0, None), (1, 1), (2, 3), (3, 5),
    ]
    assert windows.change_between_snapshots(df, "t", "at", "n").count() == 80


# --- levels, reshape, tables ----------------------------------------------------------


def test_masks_commute_with_grouping(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("a"), (F.col("id") % 5 - 1).alias("b"), F.col("id").alias("v"))
    copies = levels.masked_levels(df, {"a": F.lit(-1), "b": F.lit(-1)})
    for mask, keys in ((0, []), (1, ["a"]), (2, ["b"]), (3, ["a", "b"])):
        got = copies.where(F.col("level_mask") == mask).groupBy("a", "b").agg(F.sum("v").alias("s"))
        plain = df.groupBy(*keys).agg(F.sum("v").alias("s"))
        assert sorted(r.s for r in got.collect()) == sorted(r.s for r in plain.collect())


def test_nearest_value(rows, values):
    df = rows("k int, v double, p int", (1, 4.0, 1), (1, 6.0, 2), (1, 9.0, 3), (2, 50.0, 1))
    found = aggregates.nearest_value(df, ["k"], "v", 5.0, ["p"], 10.0, F.lit(-1.0))
    assert values(found) == [(1, 6.0), (2, -1.0)]


def test_unpivot_leaves_out_empty_cells(rows, values):
    df = rows("k int, c string, v int", (1, "a", 1), (1, "b", None), (2, "b", 5))
    wide = reshape.pivot_max(df, ["k"], "c", "v", ["a", "b"])
    assert values(reshape.unpivot(wide, ["k"], ["a", "b"], "c", "v")) == [(1, "a", 1), (2, "b", 5)]


def test_audits(rows, values):
    df = rows("k int, n int", (1, 1), (1, 2), (2, 3), (None, 4))
    assert values(quality.duplicate_keys(df, ["k"])) == [(1, 2), (None, 1)]
    parent = rows("id int", (1,))
    assert values(quality.missing_references(df, "k", parent, "id")) == [(2, 1)]
    second = rows("id int", (2,), (2,))
    assert values(quality.resolve_keys(df, "k", parent, second, "id")) == [
        (1, 2, "primary"), (2, 1, "misrouted"), (None, 1, "orphan"),
    ]


def test_delete_keeps_unknown(rows, values):
    df = rows("x int", (1,), (2,), (None,))
    assert values(filters.delete_where(df, F.col("x") > 1)) == [(1,), (None,)]


def test_upsert_replaces_and_adds(rows, values):
    target = rows("k int, v string", (1, "old"), (2, "old"))
    source = rows("k int, v string", (2, "new"), (3, "new"))
    assert values(upsert.merge_upsert(target, source, ["k"])) == [(1, "old"), (2, "new"), (3, "new")]


def test_upsert_refuses_a_repeated_source_key(rows, values):
    target = rows("k int, j int, v string", (1, 1, "old"))
    good = rows("k int, j int, v string", (1, 1, "new"), (1, 2, "new"), (None, 1, "a"), (None, 1, "b"))
    assert len(values(upsert.merge_upsert(target, good, ["k", "j"]))) == 4  # a NULL matches nothing
    twice = good.unionByName(rows("k int, j int, v string", (1, 2, "again")))
    with pytest.raises(Exception, match="several rows for k, j = 1, 2"):
        upsert.merge_upsert(target, twice, ["k", "j"]).collect()
    with pytest.raises(Exception, match="several rows"):
        upsert.merge_upsert(target, twice, ["k", "j"]).select("v").collect()


def test_latest_row_ignores_order_of_arrival(rows, values):
    df = rows("k int, at int, v string", (1, 2, "b"), (1, 3, "c"), (1, 1, "a"), (2, None, "x"), (2, 0, "y"))
    assert values(windows.first_per_key(df, ["k"], [F.col("at").desc()]).select("k", "v")) == [(1, "c"), (2, "y")]
