import datetime
import math

import pytest
from pyspark.sql import functions as F

from shelfcurve.functions import dates, numeric, predicates, text
from shelfcurve.plans.baseline import day_discount, sale_reason


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_normalise_brand(rows):
    df = rows("b string", ("Coca ООО",))
    assert one(df, text.normalise_brand(F.col("b"))) == "сoсa"
    assert one(rows("b string", ("мк мк",)), text.normalise_brand(F.col("b"))) == "мк"
    assert one(rows("b string", (None,)), text.normalise_brand(F.col("b"))) is None


@pytest.mark.parametrize("name, expected", [("a b c", "b c a"), ("abc", "abc ab"), ("x", "x "), (" a", "a ")])
def test_rotate_first_word(rows, name, expected):
    assert one(rows("s string", (name,)), text.rotate_first_word(F.col("s"))) == expected


def test_dotted_names_count_from_the_right(rows):
    df = rows("s string", ("db.dbo.t",))
    assert [one(df, text.name_part(F.col("s"), i)) for i in (1, 2, 3, 4)] == ["t", "dbo", "db", None]


def test_common_name_needs_a_comma(rows):
    assert one(rows("s string", ("CN=Readers,OU=x",)), text.common_name(F.col("s"))) == "Readers"
    assert one(rows("s string", ("CN=Readers",)), text.common_name(F.col("s"))) is None


def test_strip_line_breaks(rows):
    for tail in ("\\r\\n", "\\n", "\r\n", ""):
        assert one(rows("s string", ("Town (X)" + tail,)), text.strip_line_breaks(F.col("s"))) == "Town (X)"


@pytest.mark.parametrize(
    "paragraph", ["%py\na\nb", "%py", "%py\n", "%py\n\n", "%py\r\na\r\n", "", "\n", "\na", "%py\x0ba b", "%py\na\n\n"]
)
def test_paragraph_body_follows_splitlines(rows, paragraph):
    lines = paragraph.splitlines()[1:]
    expected = "\n".join(lines) if lines else None
    assert one(rows("s string", (paragraph,)), text.paragraph_body(F.col("s"))) == expected


def test_pair_swap(rows):
    assert one(rows("s string", ("a -- b c",)), text.swap_pair(F.col("s"))) == "b c -- a"


def test_every_nth_word(rows):
    assert one(rows("s string", ("  a b\tc\nd e ",)), text.every_nth_word(F.col("s"))) == "a c e"


@pytest.mark.parametrize(
    "first, second, expected",
    [
        (10.0, 10.0, 0), (10.0, 9.75, -25), (10.0, 9.9, -25), (10.0, 5.0, -500), (10.0, 4.99, -550),
        (10.0, 2.0, -800), (10.0, 1.99, -900), (10.0, 9.74999, -50),
        (10.0, 9.749999, -25),  # the discount has six digits
    ],
)
def test_discount_bins_widen(rows, first, second, expected):
    df = rows("a double, b double", (first, second))
    assert one(df, numeric.discount_bin(numeric.discount(F.col("a"), F.col("b")))) == expected


def test_zero_divisors_give_null(rows):
    df = rows("a double, b double, z double", (1.0, 2.0, 0.0))
    assert one(df, numeric.seasonal_growth(F.col("a"), F.col("b"), F.col("z"))) is None
    assert one(df, numeric.discount(F.col("z"), F.col("b"))) is None
    assert one(df, numeric.growth(F.col("z"), F.col("b"), F.col("a"), F.col("a"))) is None


def test_clamp_and_floor_keep_null(rows):
    df = rows("x double", (None,))
    assert one(df, numeric.clamp(F.col("x"))) is None
    assert one(df, numeric.floored_exp(F.col("x"))) is None
    assert one(rows("x double", (-40.0,)), numeric.clamp(F.col("x"))) == -35.0
    assert one(rows("x double", (-2.0,)), numeric.floored_exp(F.col("x"))) == 0.5


def test_truncating_division(rows):
    df = rows("n bigint", (-38,))
    assert (one(df, numeric.quotient(F.col("n"), 5)), one(df, F.col("n") % 5)) == (-7, -3)


def test_growth_coefficient_in_steps(rows):
    values = (None, -50.0, -1.0, 0.0, 0.4, 1.0, 3.0, 50.0)
    df = rows("a double, b double, d double", *[(a, b, d) for a in values for b in values for d in values])
    whole = numeric.growth_coefficient(F.col("a"), F.col("b"), F.col("d"))
    found = numeric.with_growth_coefficient(df, "steps", "a", "b", "d").withColumn("whole", whole)
    assert found.columns == ["a", "b", "d", "steps", "whole"]
    assert found.where(~F.col("steps").eqNullSafe(F.col("whole"))).count() == 0


def test_growth_coefficient_raises_and_lowers(rows):
    df = rows("a double, b double, d double", (0.5, 2.0, 0.25))
    expected = math.exp(0.5 + 2.0 * 0.25) - math.exp(0.5) + 1
    assert one(df, numeric.growth_coefficient(F.col("a"), F.col("b"), F.col("d"))) == pytest.approx(expected)
    df = rows("a double, b double, d double", (0.5, 2.0, -0.25))
    expected = 1 / (1 + math.exp(0.5 + 2.0 * 0.25 / 1.25) - math.exp(0.5))
    assert one(df, numeric.growth_coefficient(F.col("a"), F.col("b"), F.col("d"))) == pytest.approx(expected)
    df = rows("a double, b double, d double", (30.0, 40.0, 0.9))
    assert one(df, numeric.growth_coefficient(F.col("a"), F.col("b"), F.col("d"))) == 200.0


def test_day_discount_variants(rows):
    df = rows("t double, r double", (80.0, 100.0))
    assert one(df, day_discount(F.col("t"), F.col("r"), "share")) == pytest.approx(0.2)
    assert one(df, day_discount(F.col("t"), F.col("r"), "reciprocal")) == pytest.approx(1 / 80 / 100)
    assert one(rows("t double, r double", (120.0, 100.0)), day_discount(F.col("t"), F.col("r"), "share")) == 0.0
    assert one(rows("t double, r double", (120.0, 0.0)), day_discount(F.col("t"), F.col("r"), "share")) == 0.0


@pytest.mark.parametrize(
    "reason, factual, regular, expected",
    [
        (21001, 99.0, 100.0, 1), (24062, 99.0, 100.0, 1), (21001, 80.0, 100.0, 2), (24185, 80.0, 100.0, 0),
        (None, 80.0, 100.0, 0), (None, 99.0, 100.0, 2), (21001, 99.0, None, 2), (24185, 99.0, 0.0, 2),
    ],
)
def test_sale_reason(rows, reason, factual, regular, expected):
    df = rows("reason int, f double, r double", (reason, factual, regular))
    assert one(df, sale_reason(F.col("reason"), F.col("f"), F.col("r"), 0.05)) == expected


def test_reason_and_region_codes(rows):
    df = rows("x int", (21001,), (24062,), (21007,), (21004,), (5,), (None,))
    codes = df.select(predicates.classify(F.col("x"), predicates.REASON_TYPES, 4).alias("c")).collect()
    assert [r.c for r in codes] == [1, 1, 2, 3, 4, 4]
    df = rows("x int", (1071315,), (482104,), (482364,), (7,), (None,))
    regions = df.select(predicates.remap(F.col("x"), predicates.REGION_REMAP).alias("c")).collect()
    assert [r.c for r in regions] == [481752, 481752, 481965, 7, None]


def test_blackouts_are_closed(rows):
    df = rows("d string", ("2020-03-08",), ("2020-03-09",), ("2020-05-03",), ("2020-05-04",), ("2022-03-01",))
    df = df.select(F.col("d").cast("date").alias("d"))
    kept = df.where(predicates.outside_periods(["d"])).collect()
    assert [r.d for r in kept] == [datetime.date(2020, 3, 8), datetime.date(2020, 5, 4)]


def test_dates(rows):
    df = rows("n int", (42363,))
    assert one(df, dates.from_serial(F.col("n"))) == datetime.date(2015, 12, 25)
    assert one(df, dates.year_day(dates.from_serial(F.col("n")))) == 1225


def test_compare_code(rows):
    df = rows("a int, b int", (1, 1), (2, 1), (1, 2))
    codes = df.select(numeric.compare_code(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r.c for r in codes] == [0, 1, 2]


def test_first_titles(rows):
    feed = '{"feed":{"entry":[%s]}}' % ",".join('{"title":{"$t":"t%d"}}' % i for i in range(8))
    assert one(rows("s string", (feed,)), text.first_titles(F.col("s"))) == [f"t{i}" for i in range(6)]
