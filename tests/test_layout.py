"""Files along a space-filling curve: the same rows, and few files for a value of any column."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reelmetrics.sources import layout


def _events(spark, n=20_000, hot=0):
    df = spark.range(n).select(
        F.when(F.col("id") < hot, 7).otherwise(F.abs(F.xxhash64("id", F.lit(1))) % 5000).alias("user_id"),
        F.format_string("s%05d", F.abs(F.xxhash64("id", F.lit(2))) % 3000).alias("show_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.abs(F.xxhash64("id", F.lit(3))) % 700).cast("int")).alias("watch_date"),
        "id",
    )
    return df.withColumn("year", F.year("watch_date"))


def _admitting(path, column, value):
    """Share of the files whose statistics admit a value."""
    admit = every = 0
    for file in path.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        admit += any(s.min <= value <= s.max for s in stats)
        every += 1
    return admit / every, every


def test_each_column_opens_few_files(spark, tmp_path):
    events = _events(spark)
    clustered, plain = tmp_path / "clustered", tmp_path / "plain"
    cols = ["user_id", "show_id", "watch_date"]
    assert layout.write_clustered(events, str(clustered), cols, files=64) == 20_000
    events.repartitionByRange(64, "user_id").sortWithinPartitions(*cols).write.parquet(str(plain))
    values = {"user_id": [0, 123, 2500, 4999], "show_id": ["s00000", "s01234", "s02999"], "watch_date": [dt.date(2020, 5, 5), dt.date(2021, 6, 1)]}
    for column, some in values.items():
        for value in some:
            share, every = _admitting(clustered, column, value)
            assert every >= 50 and share <= 0.5, (column, value, share)
    # Sorted by one column, a title is in all files.
    assert _admitting(plain, "show_id", "s01234")[0] > 0.9


def test_partitions_and_rows(spark, tmp_path):
    events = _events(spark)
    path = str(tmp_path / "p")
    layout.write_clustered(events, path, ["user_id", "show_id"], ["year"], files=16)
    back = spark.read.parquet(path)
    assert back.count() == back.select(*events.columns).intersect(events).count() == 20_000
    assert len(list((tmp_path / "p").glob("year=2020/*.parquet"))) < 16
    per_year = back.where("year = 2020 AND user_id = 77").select(F.input_file_name()).distinct().count()
    assert per_year <= 6


def test_a_hot_value_fills_several_files(spark, tmp_path):
    """Half of all rows have one user; equal rows are cut by the hash alone."""
    layout.write_clustered(_events(spark, hot=10_000), str(tmp_path / "h"), ["user_id", "show_id", "watch_date"], files=16)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "h").rglob("*.parquet")]
    assert max(sizes) < 3 * 20_000 / 16
    same = spark.range(4000).select(F.lit(1).alias("user_id"), F.lit("x").alias("show_id"), "id")
    layout.write_clustered(same, str(tmp_path / "s"), ["user_id", "show_id"], files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "s").rglob("*.parquet")]
    assert len(sizes) >= 6 and max(sizes) < 1500


def test_places(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(100), rng.choice("abcdef") + rng.choice("xyz"), i) for i in range(500)] + [(None, None, 500), (3, "", 501)]
    df = spark.createDataFrame(rows, "n int, t string, id int")
    bounds = layout.range_bounds(df, ["n", "t"], bits=3)
    got = layout.with_curve_place(df, ["n", "t"], bounds, "place", bits=3).collect()
    # Bits of n and t in turn, n first; each grows with its value.
    halves = {}
    for r in got:
        n = sum((r.place >> (2 * b + 1) & 1) << b for b in range(3))
        t = sum((r.place >> (2 * b) & 1) << b for b in range(3))
        halves[r.id] = (n, t)
    known = [r for r in got if r.n is not None and r.t]
    for col, k in (("n", 0), ("t", 1)):
        order = sorted(known, key=lambda r: r[col])
        ranges = [halves[r.id][k] for r in order]
        assert ranges == sorted(ranges) and len(set(ranges)) >= 6
    assert halves[500] == (0, 0)


def test_empty_and_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "user_id bigint, show_id string, place int")
    assert layout.write_clustered(empty, str(tmp_path / "e"), ["user_id", "show_id"], files=4) == 0
    nulls = spark.createDataFrame([(None, None, 1)] * 5, "user_id bigint, show_id string, _place int")
    assert layout.write_clustered(nulls, str(tmp_path / "n"), ["user_id", "show_id"], files=4) == 5
    assert spark.read.parquet(str(tmp_path / "n")).columns == ["user_id", "show_id", "_place"]
    with pytest.raises(TypeError):
        layout.write_clustered(nulls.withColumn("a", F.array("_place")), str(tmp_path / "x"), ["a"])
    with pytest.raises(ValueError):
        layout.write_clustered(nulls, str(tmp_path / "x"), ["user_id", "show_id"], bits=40)
