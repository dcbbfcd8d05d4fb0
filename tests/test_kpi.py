"""Questions on small tables with ties, gaps and orphans."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import enrich
from reelmetrics.plans import kpi

D = dt.date
AS_OF = D(2024, 3, 1)


@pytest.fixture(scope="module")
def movies(spark):
    rows = [("s1", "Same", "Movie", "Drama", 2020), ("s2", "Same", "Movie", "Drama", 2021), ("s3", "Other", "TV Show", "Comedy", 2000), ("s4", "Unseen", "Movie", None, 1999)]
    return spark.createDataFrame(rows, "show_id string, title string, type string, primary_genre string, release_year int")


@pytest.fixture(scope="module")
def users(spark):
    rows = [(1, "Ann", "Oslo", "NO"), (2, "Ben", "Oslo", "NO"), (3, "Cas", "Rome", "IT")]
    return spark.createDataFrame(rows, "user_id bigint, name string, city string, country string")


@pytest.fixture(scope="module")
def watch(spark):
    rows = [
        (1, 1, "s1", "TV", D(2024, 1, 1), "10.0"),
        (2, 1, "s3", "TV", D(2024, 2, 28), "5.5"),
        (3, 2, "s2", "Web", D(2023, 12, 31), "20.0"),
        (4, 3, "s3", "Web", D(2024, 1, 30), "0.0"),
        (5, 9, "s9", "Web", D(2024, 1, 5), "1.0"),
        (6, None, "s1", "Web", None, "2.0"),
    ]
    rows = [(*r[:5], Decimal(r[5])) for r in rows]
    return spark.createDataFrame(rows, "watch_id bigint, user_id bigint, show_id string, device string, watch_date date, watch_duration_minutes decimal(8,1)")


@pytest.fixture(scope="module")
def subs(spark):
    rows = [
        (1, 1, 1, D(2023, 1, 1), True),
        (2, 1, 2, D(2023, 5, 1), True),
        (3, 1, 3, D(2022, 5, 1), False),
        (4, 2, 1, D(2023, 1, 1), False),
        (5, 7, 1, D(2023, 1, 1), True),
        (6, 3, 3, D(2023, 1, 1), True),
        (7, 3, 2, D(2023, 1, 1), True),
    ]
    return spark.createDataFrame(rows, "subscription_id bigint, user_id bigint, plan_id int, start_date date, is_active boolean").withColumn("monthly_revenue", F.lit("9.99").cast("decimal(8,2)"))


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_key(df):
    return sorted(rows(df), key=repr)


def test_top_titles(watch, movies):
    assert rows(kpi.kpi_top_watched_titles(watch, movies)) == [
        ("Same", "Movie", "Drama", 3, Decimal("32.0")),
        ("Other", "TV Show", "Comedy", 2, Decimal("5.5")),
    ]
    left = rows(kpi.kpi_top_watched_titles(watch, movies, how="left"))
    assert left[-1] == (None, None, None, 1, Decimal("1.0"))
    assert rows(kpi.kpi_top_titles_by_name(watch, movies, k=1)) == [("Same", 3, Decimal("32.0"))]
    assert by_key(kpi.vw_top_watched_titles(watch, movies)) == [
        ("s1", "Same", "Movie", "Drama", 2, Decimal("12.0")),
        ("s2", "Same", "Movie", "Drama", 1, Decimal("20.0")),
        ("s3", "Other", "TV Show", "Comedy", 2, Decimal("5.5")),
    ]


def test_a_repeated_dimension_row_counts_as_in_a_plain_join(watch, movies, users):
    doubled = movies.unionAll(movies.where("show_id = 's3'"))
    joined = watch.join(doubled, "show_id").groupBy("primary_genre").agg(F.count("*"), F.sum("watch_duration_minutes"))
    assert by_key(kpi.kpi_popular_genres(watch, doubled)) == by_key(joined)
    crowd = users.unionAll(users.where("user_id = 1"))
    joined = watch.join(crowd, "user_id").groupBy("city", "country").agg(F.count("*"), F.count_distinct("user_id"))
    assert by_key(kpi.kpi_active_cities(watch, crowd)) == by_key(joined)


def test_genres_and_cities(watch, movies, users):
    assert rows(kpi.kpi_popular_genres(watch, movies, ordered=True))[0] == ("Drama", 3, Decimal("32.0"))
    assert len(rows(kpi.kpi_popular_genres(watch, movies, how="left"))) == 3
    assert len(rows(kpi.kpi_popular_genres(watch, movies, how="left", drop_null=True))) == 2
    assert rows(kpi.kpi_active_cities(watch, users, ordered=True)) == [("Oslo", "NO", 3, 2), ("Rome", "IT", 1, 1)]
    assert (None, None, 2, 1) in rows(kpi.kpi_active_cities(watch, users, how="left"))


def test_devices_and_months(watch):
    assert rows(kpi.kpi_device_usage(watch, ordered=True)) == [
        ("Web", 4, Decimal("23.0"), Decimal("5.8")),
        ("TV", 2, Decimal("15.5"), Decimal("7.8")),
    ]
    assert rows(kpi.kpi_monthly_trend(watch, ordered=True)) == [
        ("2023-12", 1, Decimal("20.0"), 1),
        ("2024-01", 3, Decimal("11.0"), 3),
        ("2024-02", 1, Decimal("5.5"), 1),
        (None, 1, Decimal("2.0"), 0),
    ]
    assert [r[0] for r in rows(kpi.kpi_monthly_trend(watch, last=2, ordered=True))] == ["2024-01", "2024-02"]


def test_revenue(spark, subs):
    plans = spark.createDataFrame([(1, "Basic"), (2, "Plus")], "plan_id int, plan_name string")
    basic, plus = ("Basic", 3, Decimal("29.97"), Decimal("9.99")), ("Plus", 2, Decimal("19.98"), Decimal("9.99"))
    assert rows(kpi.kpi_revenue_by_plan(subs, plans, ordered=True)) == [basic, plus]
    assert len(rows(kpi.kpi_revenue_by_plan(subs, plans, how="left"))) == 3
    assert len(rows(kpi.kpi_revenue_by_plan(subs, plans, how="left", drop_null=True))) == 2
    assert by_key(kpi.vw_revenue_by_plan(subs, plans)) == [basic[:3], plus[:3]]


def test_top_rated(spark, movies):
    stars = {"s1": [5, 5, 4], "s2": [5, 4, 5], "s3": [5, 5], "s4": [3] * 4}
    ratings = spark.createDataFrame([(s, r) for s, rs in stars.items() for r in rs], "show_id string, rating int")
    top = rows(kpi.kpi_top_rated(ratings, movies, min_ratings=3))
    assert [(r[0], r[2], str(r[3]), r[4]) for r in top] == [("s1", 3, "4.67", 1), ("s2", 3, "4.67", 2), ("s4", 4, "3.00", 3)]
    assert [r[0] for r in rows(kpi.kpi_top_rated_raw_mean(ratings, movies, min_ratings=3, k=2))] == ["s1", "s2"]


def test_ranking_on_the_rounded_or_the_raw_mean(spark, movies):
    # Means 4.33, 4.33 and 4.32993...: equal after rounding, where s3 has the most ratings.
    stars = {"s1": (402, 198), "s2": (67, 33), "s3": (6704, 3301)}
    ratings = [(s, 4) for s, (n, _) in stars.items() for _ in range(n)]
    ratings += [(s, 5) for s, (_, n) in stars.items() for _ in range(n)]
    ratings = spark.createDataFrame(ratings, "show_id string, rating int")
    assert [r[0] for r in rows(kpi.kpi_top_rated(ratings, movies))] == ["s3", "s1", "s2"]
    assert [r[0] for r in rows(kpi.kpi_top_rated_raw_mean(ratings, movies))] == ["s1", "s2", "s3"]


def test_churn_of_users(watch, users):
    assert rows(kpi.kpi_churn_users(watch, users, AS_OF, ordered=True)) == [
        (2, "Ben", D(2023, 12, 31), 61, 1, Decimal("20.0"), "High"),
        (3, "Cas", D(2024, 1, 30), 31, 1, Decimal("0.0"), "Medium"),
        (1, "Ann", D(2024, 2, 28), 2, 2, Decimal("15.5"), "Low"),
    ]


@pytest.mark.parametrize("rows_per_slot", [1, 2, 1_000_000])
def test_engagement_repeats_a_user_per_active_subscription(watch, subs, rows_per_slot):
    churn = kpi.kpi_user_engagement_churn(watch, subs, AS_OF, rows_per_slot=rows_per_slot)
    got = by_key(churn.select("user_id", "plan_id", "start_date", "churn_risk"))
    assert got == sorted(
        [
            (1, 1, D(2023, 1, 1), "Low"),
            (1, 2, D(2023, 5, 1), "Low"),
            (2, None, None, "High"),
            (3, 2, D(2023, 1, 1), "Medium"),
            (3, 3, D(2023, 1, 1), "Medium"),
            (9, None, None, "Medium"),
            (None, None, None, "Low"),
        ],
        key=repr,
    )
    assert dict(rows(kpi.kpi_churn_distribution(churn))) == {"Low": 3, "High": 1, "Medium": 3}


def test_engagement_with_one_row_per_user(watch, subs):
    churn = kpi.kpi_user_engagement_churn(watch, subs, AS_OF, one_row_per_user=True)
    assert by_key(churn.select("user_id", "plan_id", "start_date")) == [
        (1, 2, D(2023, 5, 1)), (2, None, None), (3, 2, D(2023, 1, 1)), (9, None, None), (None, None, None)
    ]


def test_churn_of_active_subscribers(watch, subs):
    assert by_key(kpi.kpi_churn_active_subscribers(watch, subs, AS_OF)) == [
        (1, D(2024, 2, 28), 2, "Low"), (3, D(2024, 1, 30), 31, "Medium"), (7, None, None, None)
    ]


def test_top_genres_break_ties_by_name(spark, watch, movies):
    assert by_key(kpi.kpi_user_top_genres(watch, movies, k=1)) == [
        (1, "Comedy", 1, 1), (2, "Drama", 1, 1), (3, "Comedy", 1, 1), (None, "Drama", 1, 1)
    ]
    assert by_key(kpi.kpi_user_top_genres(watch, movies, k=1, slots=3)) == by_key(kpi.kpi_user_top_genres(watch, movies, k=1))
    ordered = rows(kpi.kpi_user_top_genres(watch, movies, k=5, ordered=True))
    assert [(r[0], r[3]) for r in ordered] == [(1, 1), (1, 2), (2, 1), (3, 1), (None, 1)]


def test_minutes_per_user(watch):
    assert rows(kpi.kpi_avg_watch_per_user(watch)) == [(4, Decimal("9.1"), Decimal("8.3"))]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("slots", [1, 4])
def test_lookup(watch, movies, how, slots):
    plain = watch.join(movies.select("show_id", "title"), "show_id", how)
    assert by_key(enrich.lookup(watch, movies.select("show_id", "title"), "show_id", how, slots).select(*plain.columns)) == by_key(plain)


def test_enriched_tables_keep_the_rows(watch, movies, users, subs, spark):
    people = users.withColumns({"age": F.lit(30), "signup_date": F.lit(D(2020, 1, 1)), "age_group": F.lit("Adult")})
    full = enrich.watch_enriched(watch, movies, people)
    assert full.count() == watch.count()
    assert {"title", "type", "primary_genre", "release_year", "city", "country", "age_group"} <= set(full.columns)
    raw = enrich.watch_enriched(watch, movies, people, user_attributes=enrich.USER_ATTRIBUTES_RAW)
    assert {"age", "signup_date"} <= set(raw.columns) and "age_group" not in raw.columns
    plans = spark.createDataFrame([(1, "Basic")], "plan_id int, plan_name string")
    assert enrich.subs_enriched(subs, plans, users).count() == subs.count()
    ratings = spark.createDataFrame([("s1", 5), ("zz", 1)], "show_id string, rating int")
    assert by_key(enrich.ratings_enriched(ratings, movies)) == [("s1", 5, "Same", "Drama"), ("zz", 1, None, None)]


def test_lookup_takes_no_other_join(watch, movies):
    with pytest.raises(ValueError):
        enrich.lookup(watch, movies, "show_id", "full", 2)


def test_genres_of_stored_titles_need_no_join(spark):
    """Events that carry their genre are counted as they are, also without a viewer, a title or a genre."""
    watch = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 3), (2, 9), (None, 1), (None, None), (3, 2)], "user_id int, show_id int")
    movies = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "show_id int, primary_genre string")
    titled = watch.join(movies, "show_id", "left")
    want = sorted(map(tuple, kpi.kpi_user_top_genres(watch, movies, how="left").collect()), key=repr)
    found = kpi.kpi_user_top_genres(watch, movies, how="left", titled=titled.localCheckpoint())
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
