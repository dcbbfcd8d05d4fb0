from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import quality, shares
from reelmetrics.operators.order_stats import mean_and_median


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (2, 2)], "a int, b int")
    assert rows(quality.dq_primary_key(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 1)]
    assert rows(quality.dq_primary_key(df, "b")) == [(1, 2), (2, 2)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (999,), (999,), (None,)], "user_id int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.dq_foreign_key(child, parent, "user_id", "id")) == [(999, 2)]


def test_check_passes_unknown(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "rating int")
    assert rows(quality.dq_check(df, "rating BETWEEN 1 AND 5")) == [(0,), (6,)]
    assert rows(quality.dq_check(df, F.col("rating") < 6)) == [(6,)]


def test_not_null_length_and_profile(spark):
    df = spark.createDataFrame([("abc", None, 1), (None, None, 2), ("é" * 5, "x", 3)], "s string, t string, n int")
    assert rows(quality.dq_not_null(df, ["s", "t", "n"])) == [("n", 0), ("s", 1), ("t", 2)]
    assert rows(quality.dq_max_length(df, {"s": 4, "t": 4})) == [("s", 4, 5, 1), ("t", 4, 1, 0)]
    assert [tuple(r) for r in quality.null_profile(df, k=2).collect()] == [("t", 2), ("s", 1)]
    assert quality.null_profile(df, k=None).count() == 3


def test_decimal_fit(spark):
    text = spark.createDataFrame([("1.25",), ("123456.7",), ("12.345",), ("x",), (None,)], "v string")
    assert rows(quality.dq_decimal_fit(text, {"v": "decimal(5,2)"})) == [("v", 2, 1)]
    numbers = spark.createDataFrame([(Decimal("9999999.99"),), (Decimal("1.5"),)], "v decimal(10,2)")
    assert rows(quality.dq_decimal_fit(numbers, {"v": "decimal(8,2)"})) == [("v", 1, 0)]


def test_row_counts(spark):
    counts = quality.table_row_counts({"a": spark.range(10), "b": spark.range(0)})
    assert rows(counts) == [("a", 10), ("b", 0)]
    assert rows(quality.table_row_counts({"a": spark.range(3)}, with_columns=True)) == [("a", 3, 1)]
    report = quality.dq_row_count(counts, {"a": 11, "b": 0, "c": 1}, tolerance=0.1)
    assert rows(report) == [("a", 11, 10, True), ("b", 0, 0, True), ("c", 1, None, False)]


def test_cleaning_report(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (None, -1), (None, None), (2, 3)], "k int, v int")
    report = quality.cleaning_report(df, {"unique": "k", "positive": F.col("v") > 0})
    assert rows(report) == [("positive", 5, 2), ("unique", 5, 3)]


def test_constraint_report_lists_every_rule(spark):
    tables = {
        "c": spark.createDataFrame([(1, "ab", Decimal("1.25")), (3, None, Decimal("99.50"))], "p_id int, t string, d decimal(6,2)"),
        "p": spark.createDataFrame([(1,)], "p_id int"),
    }
    report = quality.constraint_report(
        tables,
        {"p": "p_id", "q": "id"},
        [("c", "p_id", "p"), ("c", "x", "p"), ("c", "p_id", "q")],
        {"c": "p_id > 1", "p": "x > 1"},
        {"c": ["p_id", "t", "x"]},
        {"c": {"t": 1, "x": 1}},
        {"c": {"d": "decimal(3,1)", "x": "decimal(3,1)"}, "q": {"d": "decimal(3,1)"}},
        {"c": 2, "p": 3, "q": 1},
    )
    none = (None, "not checked")
    assert rows(report) == sorted(
        [
            ("primary key", "p", "p_id", 0, "ok"),
            ("primary key", "q", "id", *none),
            ("foreign key", "c", "p_id", 1, "violated"),
            ("foreign key", "c", "x", *none),
            ("foreign key", "c", "p_id", *none),
            ("check", "c", "p_id > 1", 1, "violated"),
            ("check", "p", "x > 1", *none),
            ("not null", "c", "p_id", 0, "ok"),
            ("not null", "c", "t", 1, "violated"),
            ("not null", "c", "x", *none),
            ("max length", "c", "t", 1, "violated"),
            ("max length", "c", "x", *none),
            ("decimal", "c", "d", 1, "violated"),
            ("decimal", "c", "x", *none),
            ("decimal", "q", "d", *none),
            ("row count", "c", None, 0, "ok"),
            ("row count", "p", None, 2, "violated"),
            ("row count", "q", None, *none),
        ],
        key=repr,
    )


def test_decimal_fit_sees_every_digit(spark):
    long = [("0.1000000000000000055",), ("12345678901234567.891",), ("1.25",), ("1.50000",), ("2",), ("1e-1",), ("1.25e0",)]
    assert rows(quality.dq_decimal_fit(spark.createDataFrame(long, "v string"), {"v": "decimal(20,1)"})) == [("v", 0, 4)]


def test_shares_of_fine_and_empty_measures(spark):
    fine = spark.createDataFrame([("a", Decimal("0.0149")), ("b", Decimal("0.0051"))], "k string, n decimal(8,4)")
    assert [str(r[2]) for r in rows(shares.share_of_total(fine, "k", "n"))] == ["74.5", "25.5"]
    zero = spark.createDataFrame([("a", 1), ("b", -1)], "k string, n int")
    assert [r[2] for r in rows(shares.share_of_total(zero, "k", "n"))] == [None, None]
    large = spark.createDataFrame([("a", Decimal(3 * 10**18)), ("b", Decimal(10**18))], "k string, n decimal(24,2)")
    assert [str(r[2]) for r in rows(shares.share_of_total(large, "k", "n"))] == ["75.0", "25.0"]
    with pytest.raises(TypeError):
        shares.share_of_total(spark.createDataFrame([("a", 1.5)], "k string, n double"), "k", "n")


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 100)], "k string, n int")
    assert rows(shares.share_of_total(df, "k", "n")) == [("a", 2, Decimal("66.7")), ("b", 1, Decimal("33.3"))]


def test_ordered_counts_fill_with_zero(spark):
    df = spark.createDataFrame([("High",), ("High",), (None,), ("Low",)], "risk string")
    counted = shares.ordered_counts(df, "risk", ["Low", "Medium", "High"]).orderBy("position")
    assert [tuple(r) for r in counted.collect()] == [(0, "Low", 1), (1, "Medium", 0), (2, "High", 2)]


@pytest.mark.parametrize(
    "items, mean, median",
    [
        ([1, 2, 3, 10], "4.0", "2.5"),
        ([5], "5.0", "5.0"),
        ([7, 7, 7, 9, 1], "6.2", "7.0"),
        ([-3, -1, None], "-2.0", "-2.0"),
        # Values in buckets of all three steps.
        ([1, 2**21 + 5, 2**42 + 9, 2**43 + 1, 2**50], None, str(2**42 + 9) + ".0"),
        ([0, 2**30], "536870912.0", "536870912.0"),
    ],
)
def test_mean_and_median(spark, items, mean, median):
    df = spark.createDataFrame([(x,) for x in items], "v bigint")
    row = mean_and_median(df, "v").first()
    assert row.n == len([x for x in items if x is not None])
    assert str(row.median) == median
    assert mean is None or str(row["mean"]) == mean


def test_mean_and_median_of_nothing(spark):
    assert tuple(mean_and_median(spark.createDataFrame([], "v bigint"), "v").first()) == (0, None, None)


def test_median_takes_exact_numbers_only(spark):
    with pytest.raises(TypeError):
        mean_and_median(spark.createDataFrame([(1.5,)], "v double"), "v")


def test_median_of_decimals_equals_the_built_in_one(spark):
    df = spark.range(5000).selectExpr("CAST(pmod(xxhash64(id), 1000003) / 10.0 AS decimal(12,1)) AS v")
    ours = mean_and_median(df, "v", digits=2).first()
    theirs = df.agg(F.median(F.col("v").cast("double")).alias("m")).first()
    assert float(ours.median) == pytest.approx(theirs.m, abs=1e-9)
