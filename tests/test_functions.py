from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from guestlens.functions import stats
from guestlens.functions.text import flag, lenient_decimal, null_tokens, text_key, whole_number
from guestlens.schemas import NULL_TOKENS


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.selectExpr("i", f"{expr} AS r").orderBy("i").collect()]


def test_every_null_token_is_null_and_only_whole_values(spark):
    assert column(spark, NULL_TOKENS, null_tokens("v")) == [None] * len(NULL_TOKENS)
    kept = [" ", "Nan", "NA ", "none", "N", "0", "a 'quoted' \\ one"]
    assert column(spark, kept + [None], null_tokens("v")) == kept + [None]


def test_whole_numbers_cut_toward_zero_and_keep_long_ids(spark):
    texts = ["4.9", "-4.9", " 12 ", "9007199254740993", "+7", None, "1e3"]
    assert column(spark, texts, whole_number("v")) == [4, -4, 12, 9007199254740993, 7, None, 1000]


def test_whole_number_of_other_text_raises(spark):
    with pytest.raises(PySparkException):
        column(spark, ["many"], whole_number("v"))


def test_lenient_decimals(spark):
    texts = ["8.565", " 8 ", "8,5", "abc", "1_0", "8.5d", "NaN", "inf", "", None, ".5", "-1e1"]
    values = ["8.57", "8.00", None, None, None, None, None, None, None, None, "0.50", "-10.00"]
    expected = [None if v is None else Decimal(v) for v in values]
    assert column(spark, texts, lenient_decimal("v")) == expected


def test_rating_too_big_for_its_type_raises(spark):
    with pytest.raises(PySparkException):
        column(spark, ["1000"], lenient_decimal("v"))


def test_flags(spark):
    texts = ["True", "false", "FALSE", " False ", "1", "0", "0.0", "2", "yes", None]
    expected = [True, False, False, False, True, False, False, True, True, False]
    assert column(spark, texts, flag("v")) == expected


def test_text_key_is_null_if_a_part_is(spark):
    assert column(spark, ["Rome", None], text_key("3", "'HOSTEL'", "'city'", "v")) == ["3|HOSTEL|city|Rome", None]


@pytest.mark.parametrize(
    "values, mean",
    [
        ([833] * 500_000 + [834] * 499_999 + [833], "8.33"),
        ([1, 2], "0.02"),
        ([-1, -2], "-0.02"),
        ([834, 833], "8.34"),
        ([0], "0.00"),
    ],
)
def test_mean_rounds_half_away_from_zero_once(spark, values, mean):
    total, n = sum(values), len(values)
    df = spark.range(1).selectExpr(f"{total}L AS t", f"{n}L AS n")
    text = stats.from_hundredths(stats.rounded_mean("t", "n"))
    assert df.selectExpr(f"{text} AS m").first().m == Decimal(mean)


def test_mean_of_nothing_is_null(spark):
    df = spark.range(1).selectExpr("CAST(null AS BIGINT) AS t", "0L AS n")
    assert df.selectExpr(f"{stats.rounded_mean('t', 'n')} AS m").first().m is None


def both_correlations(spark, pairs):
    """r from merged sums of single rows, and r as one aggregate."""
    rows = [(i, *[None if v is None else round(v * 100) for v in p]) for i, p in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, x bigint, y bigint").where("y IS NOT NULL")
    fine = df.groupBy("i").agg(*[F.expr(t) for t in stats.pair_sums("x", "y")])
    merged = fine.agg(*[F.expr(t) for t in stats.merged_pair_sums("x")])
    from_sums = merged.selectExpr(f"{stats.pair_correlation('x')} AS r").first().r
    whole = spark.createDataFrame(rows, "i int, x bigint, y bigint")
    return from_sums, whole.agg(F.expr(stats.correlation("x", "y")).alias("r")).first().r


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1, 1), (2, None), (3, 9), (None, 4), (5, 2)], 0.1147),
        ([(1, 1)], None),
        ([], None),
        ([(10, 8), (10, 9), (10, 7)], None),
        ([(1, 9), (2, 9), (3, 9)], None),
        ([(0.1, 9.9), (0.1, 9.8), (0.1, 3.3)], None),
        ([(1, 2), (3, 4)], 1.0),
        ([(1, 4), (3, 2)], -1.0),
        ([(None, 1), (None, 2)], None),
    ],
)
def test_correlations(spark, pairs, expected):
    for r in both_correlations(spark, pairs):
        assert r is None if expected is None else abs(r - expected) < 1e-4


@pytest.mark.parametrize(
    "values, winner",
    [
        (["-0.9D", "0.5D", "null"], "a"),
        (["0.5D", "-0.9D", "null"], "b"),
        (["null", "0.3D", "0.3D"], "b"),
        (["0.99999999999D", "1D", "-1D"], "a"),
        (["null", "null", "null"], "a"),
        (["0D", "null", "null"], "a"),
        (["null", "null", "0D"], "c"),
    ],
)
def test_strongest(spark, values, winner):
    text = stats.strongest({n: f"CAST({v} AS DOUBLE)" for n, v in zip("abc", values)})
    assert spark.range(1).selectExpr(f"{text} AS w").first().w == winner


def test_strongest_may_stay_null(spark):
    nulls = {"a": "CAST(null AS DOUBLE)", "b": "CAST(null AS DOUBLE)"}
    text = stats.strongest(nulls, default_first=False)
    assert spark.range(1).selectExpr(f"{text} AS w").first().w is None


def test_deviation(spark):
    def deviation(values):
        h = [round(v * 100) for v in values]
        df = spark.range(1).selectExpr(
            f"{len(h)}L AS n", f"{sum(h)}L AS t", f"CAST({sum(v * v for v in h)} AS DOUBLE) AS s"
        )
        return df.selectExpr(f"{stats.sample_deviation('n', 't', 's')} AS d").first().d

    assert deviation([8.5]) is None
    assert deviation([8.5, 8.5, 8.5]) == Decimal("0.00")
    assert deviation([2, 4, 4, 4, 5, 5, 7, 9]) == Decimal("2.14")
