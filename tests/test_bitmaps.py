"""Distinct viewers from bitmaps: edge rows, ranges of months, replaced months, and what is shuffled."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import clean
from reelmetrics.plans import kpi, viewer_bitmaps
from reelmetrics.sources.sample_star import SampleStar

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "user_id bigint, watch_date date, watch_duration_minutes decimal(8,1)"


def _events(spark, rows):
    return spark.createDataFrame([(u, d and dt.date.fromisoformat(d), Decimal(m)) for u, d, m in rows], SCHEMA)


EDGE = [
    (1, "2024-01-03", 10), (1, "2024-01-04", 5), (2, "2024-01-31", 1), (1, "2024-02-01", 2), (-7, "2024-02-01", 2),
    (0, "2024-02-02", 2), (32768, "2024-02-02", 2), (32769, "2024-02-29", 2), (2**62, "2024-02-29", 2),
    (None, "2024-02-11", 9), (None, "2024-03-11", 9), (3, None, 4), (None, None, 4),
]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    events = _events(spark, EDGE)
    bitmaps = viewer_bitmaps.viewer_bitmaps(events)
    assert _rows(viewer_bitmaps.monthly_trend(bitmaps)) == _rows(kpi.kpi_monthly_trend(events))
    whole = viewer_bitmaps.distinct_viewers(bitmaps).first()
    assert (whole.total_views, whole.unique_viewers) == (13, 8)


def test_nothing(spark):
    bitmaps = viewer_bitmaps.viewer_bitmaps(_events(spark, []))
    assert viewer_bitmaps.monthly_trend(bitmaps).collect() == []
    assert viewer_bitmaps.distinct_viewers(bitmaps).first().unique_viewers == 0


def test_ids_must_be_numbers(spark):
    events = _events(spark, EDGE).withColumn("user_id", F.col("user_id").cast("string"))
    with pytest.raises(TypeError):
        viewer_bitmaps.viewer_bitmaps(events)


def test_cities_with_unknown_users(spark):
    events = _events(spark, EDGE)
    users = spark.createDataFrame([(1, "Rome", "IT"), (2, None, "IT"), (0, "Rome", "IT"), (32768, "Oslo", None)], "user_id bigint, city string, country string")
    bitmaps = viewer_bitmaps.city_bitmaps(events, users)
    for how in ("inner", "left"):
        assert _rows(viewer_bitmaps.active_cities(bitmaps, how=how)) == _rows(kpi.kpi_active_cities(events, users, how=how))


def test_a_month_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    events = _events(spark, EDGE)
    viewer_bitmaps.store_bitmaps(viewer_bitmaps.viewer_bitmaps(events), path)
    files = {r[0]: r[1] for r in spark.read.parquet(path).select("watch_month", F.input_file_name()).distinct().collect()}
    late = events.unionByName(_events(spark, [(77, "2024-01-05", 1), (1, "2024-01-09", 1)]))
    january = late.where("watch_date < '2024-02-01'")
    viewer_bitmaps.store_bitmaps(viewer_bitmaps.viewer_bitmaps(january), path, replace_months=True)
    spark.catalog.refreshByPath(path)
    stored = spark.read.parquet(path)
    after = {r[0]: r[1] for r in stored.select("watch_month", F.input_file_name()).distinct().collect()}
    assert {m for m in files if files[m] != after[m]} == {"2024-01"}
    assert _rows(viewer_bitmaps.monthly_trend(stored)) == _rows(kpi.kpi_monthly_trend(late))


def test_a_range_of_months_opens_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    viewer_bitmaps.store_bitmaps(viewer_bitmaps.viewer_bitmaps(clean.clean_watch(SampleStar(spark, SF_DIR).watch())), path)
    trend = viewer_bitmaps.monthly_trend(spark.read.parquet(path), "1996-03", "1996-05")
    text = trend._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(watch_month#\d+\), \(watch_month#\d+ >= 1996-03\), \(watch_month#\d+ <= 1996-05\)\]", text)
    assert sorted(r.watch_month for r in trend.collect()) == ["1996-03", "1996-04", "1996-05"]


def _shuffled(df):
    """Bytes that the exchanges of a plan wrote."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_less_is_shuffled(spark):
    """Building the bitmaps shuffles less than counting viewers from the events, and reading them next to nothing."""
    events = clean.clean_watch(SampleStar(spark, SF_DIR).watch()).cache()
    events.count()
    try:
        from_events = _shuffled(kpi.kpi_monthly_trend(events))
        bitmaps = viewer_bitmaps.viewer_bitmaps(events).cache()
        building = _shuffled(bitmaps)
        reading = _shuffled(viewer_bitmaps.monthly_trend(bitmaps))
        assert building < from_events / 2
        assert reading < from_events / 2
        bitmaps.unpersist()
    finally:
        events.unpersist()
