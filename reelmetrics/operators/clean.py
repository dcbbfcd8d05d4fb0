"""Cleaning steps, one per table, and the small steps they are made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmetrics.functions import (
    age_bucket,
    as_of_date,
    clip_percent,
    days_between,
    free_names,
    month_key,
)

RECENT_YEARS = 3


def dedup(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep one row per key: the first in ``order_by``.

    Without ``order_by`` all other columns decide, from left to right, so the survivor
    is the same on every run, also when a lost task is run again. To keep the first row
    of the source files, read them with ``with_position=True`` and order by ``position``.

    The row number is filtered to 1, so Spark drops surplus copies in the map tasks,
    before the shuffle (``WindowGroupLimit`` in the plan). A key with very many copies
    sends at most one of them per map task.

    Rows are brought together by a hash of the key, so the result does not count as
    partitioned by the key itself. A join on the key then has a shuffle of its own on both
    sides, which the adaptive skew join needs to split a hot key of the other table. That
    costs one more shuffle of the deduplicated table, which is the smaller one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if order_by is None:
        order_by = [c for c in df.columns if c not in keys] or keys
    ordering = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]
    hashed, nth = free_names(df, "hash", "nth")
    numbered = F.row_number().over(Window.partitionBy(hashed, *keys).orderBy(*ordering))
    return df.withColumn(hashed, F.xxhash64(*keys)).withColumn(nth, numbered).where(F.col(nth) == 1).drop(nth, hashed)


def fill_unknown(df: DataFrame, cols: Sequence[str] = ("director", "primary_country"), value: str = "Unknown") -> DataFrame:
    """Replace missing text by a fixed word."""
    return df.fillna(value, subset=list(cols))


def normalize_status(df: DataFrame, col: str = "status") -> DataFrame:
    """Strip blanks and write each word with one capital letter."""
    return df.withColumn(col, F.initcap(F.trim(col)))


def binge_flag(watch: DataFrame, threshold: int = 90) -> DataFrame:
    """Mark events that were watched (almost) to the end; an unknown share is not one."""
    return watch.withColumn("is_binge", F.coalesce(F.col("completion_pct") >= threshold, F.lit(False)))


def clean_movies(movies: DataFrame, as_of: dt.date | None = None, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per title, trimmed, with its age and a flag for recent releases."""
    age = F.year(as_of_date(as_of)) - F.col("release_year")
    return dedup(movies, "show_id", order_by).withColumns(
        {
            "title": F.trim("title"),
            "primary_genre": F.trim("primary_genre"),
            "content_age_years": age,
            "is_recent_release": F.coalesce(age <= RECENT_YEARS, F.lit(False)),
        }
    )


def clean_users(
    users: DataFrame,
    bounds: str = "lt",
    null_as_senior: bool = False,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per user, with an age group."""
    return dedup(users, "user_id", order_by).withColumn(
        "age_group", age_bucket(F.col("age"), bounds, null_as_senior)
    )


def clean_subscriptions(subs: DataFrame, as_of: dt.date | None = None, normalize: bool = True) -> DataFrame:
    """Subscriptions with a uniform status, an activity flag and their length in days."""
    subs = normalize_status(subs) if normalize else subs
    until = F.coalesce(F.col("end_date"), as_of_date(as_of))
    return subs.withColumns(
        {
            "is_active": F.coalesce(F.col("status") == "Active", F.lit(False)),
            "tenure_days": days_between(until, F.col("start_date")),
        }
    )


def clean_watch(watch: DataFrame, min_exclusive: bool = False, clip: str = "upper") -> DataFrame:
    """Watch events with a valid duration, a clipped completion and a month.

    ``min_exclusive`` also drops events of zero minutes. An unknown duration is dropped.
    """
    minutes = F.col("watch_duration_minutes")
    pct_type = watch.schema["completion_pct"].dataType
    return watch.where(minutes > 0 if min_exclusive else minutes >= 0).withColumns(
        {
            "completion_pct": clip_percent(F.col("completion_pct"), clip).cast(pct_type),
            "watch_month": month_key(F.col("watch_date")),
        }
    )


def clean_ratings(ratings: DataFrame, lo: int = 1, hi: int = 5) -> DataFrame:
    """Star ratings inside the scale."""
    return ratings.where(F.col("rating").between(lo, hi))


def add_watch_year(watch: DataFrame) -> DataFrame:
    return watch.withColumn("watch_year", F.year("watch_date"))
