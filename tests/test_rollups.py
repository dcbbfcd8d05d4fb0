"""Views from partial sums: late events, failures on the way, and which partitions are read."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmetrics.plans import kpi
from reelmetrics.plans.rollups import PERIOD, RollupStore
from reelmetrics.sources import files

D = dt.date
WATCH = "user_id bigint, show_id string, watch_date date, watch_duration_minutes decimal(8,1)"


def _watch(spark, rows):
    return spark.createDataFrame([(u, s, d and D.fromisoformat(d), Decimal(m)) for u, s, d, m in rows], WATCH)


FIRST = [
    (1, "a", "2024-01-31", 10), (2, "a", "2024-01-31", 5), (1, "b", "2024-02-01", 2), (None, "b", "2024-02-01", 3),
    (1, None, "2024-02-02", 4), (3, "c", None, 7), (3, "a", "2024-12-31", 1),
]
LATE = [(1, "a", "2024-02-01", 100), (9, "z", "2024-02-01", 50)]


@pytest.fixture
def movies(spark):
    return spark.createDataFrame([("a", "A", "Movie", "Drama"), ("b", "B", None, None), ("z", "Z", "TV Show", "Crime")], "show_id string, title string, type string, primary_genre string")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _same(store, movies, events):
    assert _rows(store.vw_top_watched_titles(movies)) == _rows(kpi.vw_top_watched_titles(events, movies))
    assert _rows(store.vw_user_engagement()) == _rows(kpi.vw_user_engagement(events))


@pytest.mark.parametrize("period", ["day", "month"])
def test_late_events(spark, tmp_path, movies, period):
    store = RollupStore(spark, str(tmp_path / "s"), period)
    first, late = _watch(spark, FIRST), _watch(spark, LATE)
    assert len(store.add("watch", first)) == {"day": 5, "month": 4}[period]
    _same(store, movies, first)
    assert store.add("watch", late) == [{"day": "2024-02-01", "month": "2024-02"}[period]]
    _same(store, movies, first.unionByName(late))
    assert store.add("watch", _watch(spark, [(5, "a", None, 3)])) == [None]
    _same(store, movies, first.unionByName(late).unionByName(_watch(spark, [(5, "a", None, 3)])))
    assert files.list_names(spark, str(tmp_path / "s/due")) == []


def test_only_the_late_day_is_read_and_written(spark, tmp_path, monkeypatch):
    store = RollupStore(spark, str(tmp_path / "s"), "day")
    store.add("watch", _watch(spark, FIRST))

    def written(name):
        found = store._read(name).select(PERIOD, F.input_file_name().alias("f")).distinct().collect()
        return {(r[PERIOD], r.f) for r in found}

    before = {n: written(n) for n in ("by_show", "by_user")}
    read = []
    whole = RollupStore.periods_of
    monkeypatch.setattr(RollupStore, "periods_of", lambda self, fact, p: read.append(whole(self, fact, p)) or read[-1])
    store.add("watch", _watch(spark, LATE))
    assert {p for p, _ in before["by_show"] - written("by_show")} == {"2024-02-01"}
    assert {p for p, _ in before["by_user"] - written("by_user")} == {"2024-02-01"}
    (rows,) = read
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*period#\d+ (IN|=) \(?2024-02-01", plan)
    assert {r[0] for r in rows.select(F.input_file_name()).distinct().collect()} <= {f.replace("%3A", ":") for f in rows.inputFiles()}
    assert {r[0] for r in rows.select(PERIOD).distinct().collect()} == {"2024-02-01"}


def test_a_failed_batch_is_finished_later(spark, tmp_path, movies, monkeypatch):
    store = RollupStore(spark, str(tmp_path / "s"))
    first, late = _watch(spark, FIRST), _watch(spark, LATE)
    store.add("watch", first)
    monkeypatch.setattr(RollupStore, "_sum_up", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.add("watch", late)
    monkeypatch.undo()
    _same(store, movies, first)  # the sums of before
    assert store.refresh() == {"watch": ["2024-02"]}
    _same(store, movies, first.unionByName(late))
    assert store.refresh() == {}


def test_a_range_of_periods(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "s"))
    events = _watch(spark, FIRST)
    store.add("watch", events)
    want = kpi.vw_user_engagement(events.where("watch_date BETWEEN '2024-02-01' AND '2024-12-31'"))
    assert _rows(store.vw_user_engagement(since="2024-02", until="2024-12")) == _rows(want)


def test_revenue(spark, tmp_path):
    rows = [(1, 1, D(2024, 1, 1), Decimal("9.99")), (2, 2, D(2024, 2, 1), None), (3, None, D(2024, 2, 1), Decimal(1)), (4, 1, None, Decimal(2))]
    subs = spark.createDataFrame(rows, "subscription_id bigint, plan_id int, start_date date, monthly_revenue decimal(8,2)")
    plans = spark.createDataFrame([(1, "Basic"), (2, "Plus"), (4, "Plus")], "plan_id int, plan_name string")
    store = RollupStore(spark, str(tmp_path / "s"))
    store.add("subscriptions", subs.where("subscription_id < 3"))
    store.add("subscriptions", subs.where("subscription_id >= 3"))
    assert _rows(store.vw_revenue_by_plan(plans)) == _rows(kpi.vw_revenue_by_plan(subs, plans))


def test_stored_views_see_new_periods(spark, tmp_path, movies):
    store = RollupStore(spark, str(tmp_path / "s"))
    store.add("watch", _watch(spark, FIRST))
    store.add("subscriptions", spark.createDataFrame([(1, D(2024, 1, 1), Decimal(3))], "plan_id int, start_date date, monthly_revenue decimal(8,2)"))
    spark.sql("CREATE TABLE roll_plans (plan_id INT, plan_name STRING) USING parquet")
    movies.write.saveAsTable("roll_movies")
    try:
        store.create_views("roll_")
        store.add("watch", _watch(spark, [(1, "a", "2025-01-01", 8)]))
        store.create_views("roll_")
        everything = _watch(spark, [*FIRST, (1, "a", "2025-01-01", 8)])
        assert _rows(spark.table("roll_vw_UserEngagement")) == _rows(kpi.vw_user_engagement(everything))
        assert _rows(spark.table("roll_vw_TopWatchedTitles")) == _rows(kpi.vw_top_watched_titles(everything, movies))
        assert spark.table("roll_vw_RevenueByPlan").collect() == []
    finally:
        store.drop_views("roll_")
        for t in ("movies", "plans"):
            spark.sql(f"DROP TABLE roll_{t}")


def test_periods_are_named(spark, tmp_path):
    with pytest.raises(ValueError):
        RollupStore(spark, str(tmp_path), "week")
