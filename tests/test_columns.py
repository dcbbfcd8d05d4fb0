"""Boundary values of the derived columns."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmetrics.functions import age_bucket, churn_bucket, clip_percent, exact_mean, month_key, percent_of
from reelmetrics.operators import clean, enrich

D = dt.date


def values(spark, items, type_, expr):
    df = spark.createDataFrame(list(enumerate(items)), f"i int, x {type_}").orderBy("i")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


AGES = [None, -1, 0, 17, 18, 29, 30, 44, 45, 100, 101]
T, Y, A, S = "Teen", "Young Adult", "Adult", "Senior"


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, [None, T, T, T, Y, Y, A, A, S, S, S]),
        ({"null_as_senior": True}, [S, T, T, T, Y, Y, A, A, S, S, S]),
        ({"bounds": "le"}, [None, None, None, T, T, Y, Y, A, A, S, None]),
    ],
)
def test_age_bucket(spark, options, expected):
    assert values(spark, AGES, "int", age_bucket(F.col("x"), **options)) == expected


DAYS = [None, -2, -1, 0, 30, 31, 60, 61, 100000, 100001]
LO, ME, HI = "Low", "Medium", "High"


def test_churn_bucket(spark):
    lenient = values(spark, DAYS, "int", churn_bucket(F.col("x")))
    strict = values(spark, DAYS, "int", churn_bucket(F.col("x"), strict=True))
    assert lenient == [LO, LO, LO, LO, LO, ME, ME, HI, HI, HI]
    assert strict == [None, None, None, LO, LO, ME, ME, HI, HI, None]


def test_clip_percent(spark):
    items = [None, Decimal("-5.0"), Decimal("100.0"), Decimal("100.1"), Decimal("150.0")]
    upper = values(spark, items, "decimal(5,1)", clip_percent(F.col("x")))
    both = values(spark, items, "decimal(5,1)", clip_percent(F.col("x"), "both"))
    assert upper == [None, Decimal(-5), 100, 100, 100]
    assert both == [None, 0, 100, 100, 100]


def test_unknown_options_are_errors():
    with pytest.raises(ValueError):
        age_bucket(F.lit(1), "between")
    with pytest.raises(ValueError):
        clip_percent(F.lit(1), "lower")


def test_month_key(spark):
    assert values(spark, [None, D(2024, 3, 31)], "date", month_key(F.col("x"))) == [None, "2024-03"]


def test_means_round_half_up(spark):
    df = spark.sql("SELECT CAST(1.0 AS decimal(18,1)) AS total, 4L AS n, 0L AS none, 201L AS stars, 200L AS rated")
    row = df.select(
        exact_mean(F.col("total"), F.col("n"), 1).alias("a"),
        exact_mean(F.col("stars"), F.col("rated"), 2).alias("b"),
        percent_of(F.lit(1), F.lit(800), 2).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (Decimal("0.3"), Decimal("1.01"), Decimal("0.13"))


def test_dedup_keeps_the_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (1, None, 1), (2, None, 9), (None, "x", 1), (None, "y", 0)], "k int, s string, n int")
    assert {(r.k, r.s) for r in clean.dedup(df, "k").collect()} == {(1, "a"), (2, None), (None, "x")}
    by_n = clean.dedup(df, "k", [F.desc("n")])
    assert {(r.k, r.n) for r in by_n.collect()} == {(1, 3), (2, 9), (None, 1)}


def test_clean_watch(spark):
    rows = [(Decimal("-1.0"), Decimal(50)), (Decimal(0), None), (Decimal("0.1"), Decimal(150)), (None, Decimal(1)), (Decimal(7), Decimal(-5))]
    df = spark.createDataFrame([(D(2024, 1, 31), *r) for r in rows], "watch_date date, watch_duration_minutes decimal(8,1), completion_pct decimal(5,1)")
    kept = clean.clean_watch(df)
    assert kept.schema["completion_pct"].dataType == df.schema["completion_pct"].dataType
    assert sorted((r.watch_duration_minutes, str(r.completion_pct)) for r in kept.collect()) == [
        (Decimal(0), "None"), (Decimal("0.1"), "100.0"), (Decimal(7), "-5.0")
    ]
    strict = clean.clean_watch(df, min_exclusive=True, clip="both").collect()
    assert sorted((r.watch_duration_minutes, r.completion_pct, r.watch_month) for r in strict) == [
        (Decimal("0.1"), 100, "2024-01"), (Decimal(7), 0, "2024-01")
    ]
    flags = {r.watch_duration_minutes: r.is_binge for r in clean.binge_flag(kept).collect()}
    assert flags == {Decimal(0): False, Decimal("0.1"): True, Decimal(7): False}


def test_clean_ratings(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "rating int")
    assert sorted(r.rating for r in clean.clean_ratings(df).collect()) == [1, 5]


def test_clean_subscriptions(spark):
    rows = [(1, D(2024, 1, 1), None, " aCTIVE "), (2, D(2024, 1, 1), D(2024, 1, 31), "Active"), (3, D(2024, 1, 1), None, None)]
    df = spark.createDataFrame(rows, "subscription_id int, start_date date, end_date date, status string")
    as_of = D(2024, 3, 1)
    got = {r.subscription_id: (r.status, r.is_active, r.tenure_days) for r in clean.clean_subscriptions(df, as_of).collect()}
    assert got == {1: ("Active", True, 60), 2: ("Active", True, 30), 3: (None, False, 60)}
    exact = {r.subscription_id: r.is_active for r in clean.clean_subscriptions(df, as_of, normalize=False).collect()}
    assert exact == {1: False, 2: True, 3: False}


def test_clean_movies(spark):
    rows = [("a", " One ", " Drama", 2021), ("b", "Two", None, 2020), ("c", None, "x", 2030), ("d", "Four", "y", None)]
    df = spark.createDataFrame(rows, "show_id string, title string, primary_genre string, release_year int")
    got = {r.show_id: tuple(r)[1:] for r in clean.clean_movies(df, D(2024, 6, 1)).collect()}
    assert got == {
        "a": ("One", "Drama", 2021, 3, True),
        "b": ("Two", None, 2020, 4, False),
        "c": (None, "x", 2030, -6, True),
        "d": ("Four", "y", None, None, False),
    }


def test_today_is_the_default(spark):
    df = spark.createDataFrame([("a", "t", "g", 2000)], "show_id string, title string, primary_genre string, release_year int")
    assert clean.clean_movies(df).first().content_age_years >= 25


def test_fill_unknown(spark):
    df = spark.createDataFrame([(None, "x", None), ("d", None, "t")], "director string, primary_country string, title string")
    assert sorted(map(tuple, clean.fill_unknown(df).collect()), key=str) == [("Unknown", "x", None), ("d", "Unknown", "t")]


def test_helper_columns_leave_those_of_the_caller_alone(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 7)], "k int, _hash string, _Nth int")
    kept = clean.dedup(df, "k")
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a", 5), (2, "c", 7)]
    dim = spark.createDataFrame([(1, "x")], "k int, __slot string")
    joined = enrich.lookup(df.withColumnRenamed("_hash", "_slot"), dim, "k", slots=3)
    assert sorted(map(tuple, joined.collect()), key=repr) == [(1, "a", 5, "x"), (1, "b", 6, "x"), (2, "c", 7, None)]
