"""Random small tables against plain Python."""

import datetime as dt
import statistics
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelmetrics.operators import clean, quality
from reelmetrics.operators.order_stats import mean_and_median
from reelmetrics.plans import kpi

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
small = st.one_of(st.none(), st.integers(0, 4))


def half_up(x, digits=1):
    return Decimal(x).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


@few
@given(st.lists(st.one_of(st.integers(-20, 20), st.integers(-(2**55), 2**55)), min_size=1, max_size=40))
def test_mean_and_median(spark, items):
    row = mean_and_median(spark.createDataFrame([(x,) for x in items], "v bigint"), "v").first()
    assert row.n == len(items)
    ordered = sorted(items)
    middle = Decimal(ordered[(len(items) - 1) // 2] + ordered[len(items) // 2]) / 2
    assert row.median == half_up(middle)
    assert row["mean"] == half_up(Decimal(sum(items)) / len(items))
    assert statistics.median(items) == float(middle) or abs(middle) > 2**50


@few
@given(st.lists(st.tuples(small, small, small), max_size=30))
def test_dedup_and_keys(spark, items):
    df = spark.createDataFrame(items, "k int, a int, b int")
    groups = {}
    for k, a, b in items:
        groups.setdefault(k, []).append((a is None, a or 0, b is None, b or 0, (k, a, b)))
    assert sorted(map(repr, map(tuple, clean.dedup(df, "k").collect()))) == sorted(repr(min(g)[-1]) for g in groups.values())
    repeated = {k: len(g) for k, g in groups.items() if len(g) > 1 or k is None}
    assert {r.k: r["rows"] for r in quality.dq_primary_key(df, "k").collect()} == repeated


@few
@given(st.lists(st.tuples(small, st.integers(0, 5)), max_size=40), st.integers(1, 3))
def test_top_genres(spark, items, k):
    genres = {0: "a", 1: "a", 2: "b", 3: "c", 4: None}
    movies = spark.createDataFrame(list(genres.items()), "show_id int, primary_genre string")
    watch = spark.createDataFrame(items, "user_id int, show_id int")
    counts = Counter((u, genres[s]) for u, s in items if s in genres)
    expected = []
    for user in {u for u, _ in counts}:
        ranked = sorted((-n, g is None, g or "", g) for (u, g), n in counts.items() if u == user)
        expected += [(user, g, -n, i) for i, (n, _, _, g) in enumerate(ranked[:k], 1)]
    assert sorted(map(repr, map(tuple, kpi.kpi_user_top_genres(watch, movies, k).collect()))) == sorted(map(repr, expected))


@few
@given(st.lists(small, min_size=1, max_size=12), st.lists(st.tuples(small, st.booleans()), max_size=25), st.integers(1, 5))
def test_engagement_and_subscriptions(spark, watchers, subs, rows_per_slot):
    day = dt.date(2024, 1, 1)
    watch = spark.createDataFrame([(u, day, Decimal(1)) for u in watchers], "user_id int, watch_date date, watch_duration_minutes decimal(8,1)")
    table = [(i, u, i % 3, day, active) for i, (u, active) in enumerate(subs)]
    subscriptions = spark.createDataFrame(table, "subscription_id int, user_id int, plan_id int, start_date date, is_active boolean")
    expected = []
    for user, sessions in Counter(watchers).items():
        plans = [p for _, u, p, _, active in table if active and u == user and u is not None]
        expected += [(user, sessions, p) for p in plans or [None]]
    got = kpi.kpi_user_engagement_churn(watch, subscriptions, day, rows_per_slot=rows_per_slot)
    assert sorted(map(repr, map(tuple, got.select("user_id", "total_sessions", "plan_id").collect()))) == sorted(map(repr, expected))
