"""Exact distinct viewers from stored bitmaps.

A bitmap row holds the viewers of one month (and city) whose ids lie in one range of 32,768 ids, a bit
for each. Bitmaps are formed in the map tasks, so a month leaves a task as one row per range of ids,
not as one row per viewer, and they can be united: the distinct viewers of any set of months are the
bits of the united bitmaps. Reports on viewers read the stored table, not the events.

A row takes 4 KB, less when compressed, so this pays where a range of ids has some tens of viewers or
more in a task; ids should be numbered without large gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from reelmetrics.functions import month_key
from reelmetrics.plans.kpi import MINUTES
from reelmetrics.sources.writers import write_curated

MONTH = "watch_month"


def _bitmaps(df: DataFrame, by: Sequence[str], views: Column, minutes: Column) -> DataFrame:
    if not isinstance(df.schema["user_id"].dataType, IntegralType):
        raise TypeError(f"user_id must be an integer, not {df.schema['user_id'].dataType.simpleString()}")
    user = F.col("user_id").cast("bigint")
    return df.groupBy(*by, F.bitmap_bucket_number(user).alias("id_range")).agg(
        views.alias("views"), minutes.alias("minutes"), F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("viewers")
    )


def viewer_bitmaps(watch: DataFrame) -> DataFrame:
    """``watch_month, id_range, views, minutes, viewers``: events, minutes and a bitmap of viewers.

    Events without a viewer have the range NULL and no bit; events without a date the month NULL.
    """
    dated = watch.withColumn(MONTH, month_key(F.col("watch_date")))
    return _bitmaps(dated, [MONTH], F.count(F.lit(1)), F.sum(MINUTES))


def city_bitmaps(watch: DataFrame, users: DataFrame) -> DataFrame:
    """The same by month and home of the viewer: ``city, country`` and ``known``, whether there is such a user.

    Events are summed by month and viewer before they meet the users, of which there must be one
    row per id.
    """
    per_viewer = (
        watch.groupBy(F.trunc("watch_date", "MM").alias("month"), "user_id")
        .agg(F.count(F.lit(1)).alias("views"), F.sum(MINUTES).alias("minutes"))
        .withColumn(MONTH, month_key(F.col("month")))
    )
    homes = users.select("user_id", "city", "country", F.lit(True).alias("known"))
    placed = per_viewer.join(homes, "user_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return _bitmaps(placed, [MONTH, "city", "country", "known"], F.sum("views"), F.sum("minutes"))


def store_bitmaps(bitmaps: DataFrame, path: str, replace_months: bool = False) -> int:
    """Write bitmaps by month and return their rows.

    ``replace_months`` replaces the months that occur in ``bitmaps`` and keeps all others, so a month
    with late events is built again from its own events alone.
    """
    return write_curated(bitmaps, path, [MONTH], dynamic=replace_months)


def in_months(bitmaps: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The months from ``first`` to ``last``, such as ``2024-03``; without a bound also NULL."""
    if first is not None:
        bitmaps = bitmaps.where(F.col(MONTH) >= first)
    return bitmaps if last is None else bitmaps.where(F.col(MONTH) <= last)


def distinct_viewers(bitmaps: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Events, minutes and distinct viewers per group of a stored table, or of all of it.

    Bitmaps of one range of ids are united in the map tasks; a range has 4 KB per group, whatever
    the number of its events. ``by`` may hold named expressions, for example quarters.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    names = bitmaps.select(*keys).columns if keys else []
    united = bitmaps.groupBy(*keys, "id_range").agg(
        F.sum("views").alias("views"), F.sum("minutes").alias("minutes"), F.bitmap_or_agg("viewers").alias("viewers")
    )
    return united.groupBy(*names).agg(
        F.sum("views").alias("total_views"),
        F.round(F.sum("minutes"), 1).alias("total_minutes"),
        F.coalesce(F.sum(F.bitmap_count("viewers")), F.lit(0)).alias("unique_viewers"),
    )


def monthly_trend(bitmaps: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """``kpi_monthly_trend`` from a stored table, of all months or of a range of them."""
    return distinct_viewers(in_months(bitmaps, first, last), [MONTH])


def active_cities(bitmaps: DataFrame, first: str | None = None, last: str | None = None, how: str = "inner") -> DataFrame:
    """``kpi_active_cities`` from stored city bitmaps, of all months or of a range of them."""
    chosen = in_months(bitmaps, first, last)
    chosen = chosen.where("known") if how == "inner" else chosen
    return distinct_viewers(chosen, ["city", "country"]).select(
        "city", "country", F.col("total_views").alias("watch_events"), F.col("unique_viewers").alias("active_users")
    )
