"""The business questions. Every function takes and returns DataFrames and runs nothing.

Two rules hold throughout:

* Facts are summed by the foreign key of a dimension before they are joined to it. Spark
  combines in the map tasks, so one row per key and task is shuffled, the join sees one
  row per key, and a key that holds a large part of all events is no heavier than others.
  The join then reuses the partitioning of the sum.
* A ranking always ends with a unique key, and missing values rank last.

``ordered=True`` sorts a report for display. It is off by default, because a sort needs
one more shuffle and the order is lost when the result is stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmetrics.functions import as_of_date, churn_bucket, days_between, exact_mean, month_key, require_exact
from reelmetrics.operators.clean import dedup
from reelmetrics.operators.enrich import lookup
from reelmetrics.operators.order_stats import mean_and_median

MINUTES = "watch_duration_minutes"


def _rows() -> Column:
    return F.count(F.lit(1))


def _desc(col: str) -> Column:
    return F.desc_nulls_last(col)


def _asc(col: str) -> Column:
    return F.asc_nulls_last(col)


def _report(df: DataFrame, order: list[Column], k: int | None, ordered: bool) -> DataFrame:
    if k is not None:
        return df.orderBy(*order).limit(k)
    return df.orderBy(*order) if ordered else df


# -- titles and genres ---------------------------------------------------------------


def views_by_show(watch: DataFrame, count_col: str | None = None) -> DataFrame:
    """Views and minutes per ``show_id``: the rollup that the reports on titles start from.

    Several reports can share one: keep it, and pass it as ``rollup``.
    """
    views = _rows() if count_col is None else F.count(count_col)
    return watch.groupBy("show_id").agg(views.alias("views"), F.sum(MINUTES).alias("minutes"))


def _with_titles(per_show: DataFrame, movies: DataFrame, attributes: list[str], how: str) -> DataFrame:
    return per_show.join(movies.select("show_id", *attributes), "show_id", how)


def kpi_top_watched_titles(
    watch: DataFrame, movies: DataFrame, k: int | None = 10, how: str = "inner", rollup: DataFrame | None = None
) -> DataFrame:
    """The ``k`` most viewed titles, by name, type and genre."""
    keys = ["title", "type", "primary_genre"]
    totals = (
        _with_titles(views_by_show(watch) if rollup is None else rollup, movies, keys, how)
        .groupBy(*keys)
        .agg(F.sum("views").alias("total_views"), F.round(F.sum("minutes"), 1).alias("total_watch_minutes"))
    )
    return _report(totals, [_desc("total_views"), *map(_asc, keys)], k, False)


def kpi_top_titles_by_name(watch: DataFrame, movies: DataFrame, k: int | None = 10, count_col: str = "watch_id") -> DataFrame:
    """The ``k`` most viewed titles by name alone; events without a title take no part."""
    totals = (
        _with_titles(views_by_show(watch, count_col), movies, ["title"], "inner")
        .where(F.col("title").isNotNull())
        .groupBy("title")
        .agg(F.sum("views").alias("total_views"), F.sum("minutes").alias("total_minutes"))
    )
    return _report(totals, [_desc("total_views"), _asc("title")], k, False)


def kpi_popular_genres(
    watch: DataFrame,
    movies: DataFrame,
    k: int | None = None,
    how: str = "inner",
    drop_null: bool = False,
    ordered: bool = False,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Views and minutes per genre, or the ``k`` genres with the most minutes."""
    totals = (
        _with_titles(views_by_show(watch) if rollup is None else rollup, movies, ["primary_genre"], how)
        .groupBy("primary_genre")
        .agg(F.sum("views").alias("view_count"), F.round(F.sum("minutes"), 1).alias("total_minutes"))
    )
    totals = totals.where(F.col("primary_genre").isNotNull()) if drop_null else totals
    return _report(totals, [_desc("total_minutes"), _asc("primary_genre")], k, ordered)


def watch_events_by_type(watch: DataFrame, movies: DataFrame) -> DataFrame:
    """Watch events per kind of title; events without a known kind take no part."""
    return (
        _with_titles(views_by_show(watch), movies, ["type"], "inner")
        .where(F.col("type").isNotNull())
        .groupBy("type")
        .agg(F.sum("views").alias("watch_events"))
    )


def vw_top_watched_titles(watch: DataFrame, movies: DataFrame) -> DataFrame:
    """Views and minutes of every watched title."""
    keys = ["show_id", "title", "type", "primary_genre"]
    return (
        _with_titles(views_by_show(watch), movies, keys[1:], "inner")
        .groupBy(*keys)
        .agg(F.sum("views").alias("total_views"), F.sum("minutes").alias("total_watch_minutes"))
    )


# -- cities, plans, devices, months --------------------------------------------------


def kpi_active_cities(
    watch: DataFrame,
    users: DataFrame,
    k: int | None = None,
    how: str = "inner",
    drop_null: bool = False,
    ordered: bool = False,
    rollup: DataFrame | None = None,
    approx: float | None = None,
) -> DataFrame:
    """Watch events and distinct viewers per city, or the ``k`` cities with most events.

    ``approx`` counts viewers by a sketch with that relative standard deviation.
    """
    per_user = vw_user_engagement(watch) if rollup is None else rollup
    viewers = F.count_distinct("user_id") if approx is None else F.approx_count_distinct("user_id", approx)
    totals = (
        per_user.join(users.select("user_id", "city", "country"), "user_id", how)
        .groupBy("city", "country")
        .agg(F.sum("total_sessions").alias("watch_events"), viewers.alias("active_users"))
    )
    totals = totals.where(F.col("city").isNotNull() & F.col("country").isNotNull()) if drop_null else totals
    return _report(totals, [_desc("watch_events"), _asc("city"), _asc("country")], k, ordered)


def _plan_totals(subs: DataFrame, plans: DataFrame, how: str) -> DataFrame:
    require_exact(subs, "monthly_revenue")
    per_plan = subs.groupBy("plan_id").agg(
        _rows().alias("rows"), F.sum("monthly_revenue").alias("revenue"), F.count("monthly_revenue").alias("priced")
    )
    return (
        per_plan.join(plans.select("plan_id", "plan_name"), "plan_id", how)
        .groupBy("plan_name")
        .agg(
            F.sum("rows").alias("subscription_count"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("priced").alias("priced"),
        )
    )


def kpi_revenue_by_plan(
    subs: DataFrame, plans: DataFrame, how: str = "inner", drop_null: bool = False, ordered: bool = False
) -> DataFrame:
    """Subscriptions of all statuses, their revenue and its mean, per plan."""
    totals = _plan_totals(subs, plans, how).select(
        "plan_name",
        "subscription_count",
        "total_revenue",
        exact_mean(F.col("total_revenue"), F.col("priced"), 2).alias("avg_revenue_per_sub"),
    )
    totals = totals.where(F.col("plan_name").isNotNull()) if drop_null else totals
    return _report(totals, [_desc("total_revenue"), _asc("plan_name")], None, ordered)


def vw_revenue_by_plan(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions and revenue per plan."""
    return _plan_totals(subs, plans, "inner").drop("priced")


def kpi_device_usage(watch: DataFrame, ordered: bool = False) -> DataFrame:
    """Sessions and minutes per kind of device. Reads no dimension."""
    require_exact(watch, MINUTES)
    totals = (
        watch.groupBy("device")
        .agg(_rows().alias("sessions"), F.sum(MINUTES).alias("minutes"), F.count(MINUTES).alias("timed"))
        .select(
            "device",
            "sessions",
            F.round("minutes", 1).alias("total_minutes"),
            exact_mean(F.col("minutes"), F.col("timed"), 1).alias("avg_minutes_per_session"),
        )
    )
    return _report(totals, [_desc("sessions"), _asc("device")], None, ordered)


def kpi_monthly_trend(
    watch: DataFrame, last: int | None = None, ordered: bool = False, approx: float | None = None
) -> DataFrame:
    """Views, minutes and distinct viewers per month, or of the ``last`` months with a date.

    Groups by the first day of the month and formats the text afterwards, once per month. The
    last months are found from the dates alone; only their events are then shuffled by viewer.

    ``approx`` counts viewers by a sketch with that relative standard deviation, for example
    0.02: one small row per month and task is shuffled in place of all viewers.
    """
    month = F.trunc("watch_date", "MM")
    if last is not None:
        newest = watch.select(month.alias("month")).where(F.col("month").isNotNull()).distinct().orderBy(F.desc("month")).limit(last)
        watch = watch.where(F.col("watch_date") >= newest.agg(F.min("month")).scalar())
    viewers = F.count_distinct("user_id") if approx is None else F.approx_count_distinct("user_id", approx)
    per_month = watch.groupBy(month.alias("month")).agg(
        _rows().alias("total_views"), F.round(F.sum(MINUTES), 1).alias("total_minutes"), viewers.alias("unique_viewers")
    )
    trend = per_month.select(
        month_key(F.col("month")).alias("watch_month"), "total_views", "total_minutes", "unique_viewers"
    )
    return _report(trend, [_asc("watch_month")], None, ordered)


# -- ratings -------------------------------------------------------------------------


def _rated_titles(ratings: DataFrame, movies: DataFrame, min_ratings: int, how: str) -> DataFrame:
    """Number and sum of star ratings per title with enough of them.

    The second grouping is by keys that start with the partitioning key of the first, so
    it needs no shuffle of its own.
    """
    per_show = ratings.groupBy("show_id").agg(
        _rows().alias("rows"), F.sum("rating").alias("stars"), F.count("rating").alias("rated")
    )
    return (
        per_show.join(movies.select("show_id", "title"), "show_id", how)
        .groupBy("show_id", "title")
        .agg(F.sum("rows").alias("num_ratings"), F.sum("stars").alias("stars"), F.sum("rated").alias("rated"))
        .where(F.col("num_ratings") >= min_ratings)
    )


def kpi_top_rated(ratings: DataFrame, movies: DataFrame, min_ratings: int = 5, k: int = 20, how: str = "inner") -> DataFrame:
    """The ``k`` best titles by mean rating with two decimals, then by number of ratings.

    The top ``k`` rows are cut before they are numbered, so the window holds ``k`` rows.
    """
    best = [_desc("avg_rating"), _desc("num_ratings"), _asc("show_id"), _asc("title")]
    top = (
        _rated_titles(ratings, movies, min_ratings, how)
        .select("show_id", "title", "num_ratings", exact_mean(F.col("stars"), F.col("rated"), 2).alias("avg_rating"))
        .orderBy(*best)
        .limit(k)
    )
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*best)))


def kpi_top_rated_raw_mean(ratings: DataFrame, movies: DataFrame, min_ratings: int = 5, k: int = 10) -> DataFrame:
    """The ``k`` best titles by the unrounded mean, which is rounded for display only."""
    raw_mean = F.col("stars").cast("double") / F.col("rated")
    return (
        _rated_titles(ratings, movies, min_ratings, "inner")
        .where(F.col("title").isNotNull())
        .orderBy(raw_mean.desc_nulls_last(), _desc("num_ratings"), _asc("show_id"), _asc("title"))
        .limit(k)
        .select("show_id", "title", "num_ratings", exact_mean(F.col("stars"), F.col("rated"), 2).alias("avg_rating"))
    )


# -- viewers -------------------------------------------------------------------------


def vw_user_engagement(watch: DataFrame) -> DataFrame:
    """Sessions, minutes and last watch date per viewer.

    This is also the rollup that the reports on viewers start from.
    """
    return watch.groupBy("user_id").agg(
        _rows().alias("total_sessions"),
        F.sum(MINUTES).alias("total_watch_minutes"),
        F.max("watch_date").alias("last_watch_date"),
    )


def _with_recency(df: DataFrame, as_of: dt.date | None, strict: bool = False) -> DataFrame:
    return df.withColumn("days_since_last_watch", days_between(as_of_date(as_of), F.col("last_watch_date"))).withColumn(
        "churn_risk", churn_bucket(F.col("days_since_last_watch"), strict)
    )


def kpi_churn_users(watch: DataFrame, users: DataFrame, as_of: dt.date | None = None, ordered: bool = False) -> DataFrame:
    """Recency and churn risk of every viewer that is a known user."""
    listed = _with_recency(vw_user_engagement(watch).join(users.select("user_id", "name"), "user_id"), as_of).select(
        "user_id",
        "name",
        "last_watch_date",
        "days_since_last_watch",
        "total_sessions",
        F.round("total_watch_minutes", 1).alias("total_watch_minutes"),
        "churn_risk",
    )
    return _report(listed, [_desc("days_since_last_watch"), _asc("user_id")], None, ordered)


def kpi_user_engagement_churn(
    watch: DataFrame,
    subs: DataFrame,
    as_of: dt.date | None = None,
    one_row_per_user: bool = False,
    rows_per_slot: int = 1_000_000,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Recency, churn risk and active subscriptions of every viewer.

    A viewer with several active subscriptions has one row for each. With
    ``one_row_per_user`` only the subscription that started last (then the one with the
    smaller plan) is kept. ``subs`` must be cleaned, so that ``is_active`` is there.

    Equal subscriptions of a user are counted in the map tasks, travel as one row and are
    repeated after the join. A user with more than ``rows_per_slot`` active subscriptions
    is spread over several slots, and so are the copies of one subscription, in portions
    of that size. The list of such users has at most (active rows / ``rows_per_slot``)
    entries and is joined by its key; Spark broadcasts it if it is small. A slot of such a
    user may stay empty; it is then removed again, as this user has other slots that are not.
    """
    engagement = _with_recency(vw_user_engagement(watch) if rollup is None else rollup, as_of).withColumn(
        "total_watch_minutes", F.round("total_watch_minutes", 1)
    )
    active = subs.where("is_active").where(F.col("user_id").isNotNull())
    if one_row_per_user:
        newest_first = [_desc("start_date"), _asc("plan_id")]
        newest = dedup(active.select("user_id", "plan_id", "start_date"), "user_id", newest_first)
        joined = engagement.join(newest, "user_id", "left")
    else:
        held, heavy = _held(active, rows_per_slot)
        slots = F.coalesce("_slots", F.lit(1))
        portion = F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {rows_per_slot}")))
        placed = (
            held.join(heavy, "user_id", "left")
            .withColumn("_portion", portion)
            .select(
                "user_id",
                "plan_id",
                "start_date",
                F.pmod(F.xxhash64("plan_id", "start_date", "_portion"), slots).cast("int").alias("_slot"),
                F.least(F.col("_copies") - F.col("_portion") * rows_per_slot, F.lit(rows_per_slot)).alias("_copies"),
            )
        )
        joined = (
            engagement.join(heavy, "user_id", "left")
            .withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1)))
            .join(placed, ["user_id", "_slot"], "left")
            .where(F.col("_slots").isNull() | F.col("_copies").isNotNull())
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))))
        )
    return joined.select(
        "user_id",
        "last_watch_date",
        "total_sessions",
        "total_watch_minutes",
        "plan_id",
        "start_date",
        "days_since_last_watch",
        "churn_risk",
    )


def _held(active: DataFrame, rows_per_slot: int) -> tuple[DataFrame, DataFrame]:
    """Equal active subscriptions with their number, and the slots of users with very many."""
    held = active.groupBy("user_id", "plan_id", "start_date").agg(_rows().alias("_copies"))
    total = active.groupBy("user_id").agg(_rows().alias("_held")).where(F.col("_held") > rows_per_slot)
    return held, total.select("user_id", F.ceil(F.col("_held") / rows_per_slot).cast("int").alias("_slots"))


def kpi_churn_distribution_of_rows(watch: DataFrame, subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Rows of ``kpi_user_engagement_churn`` per risk, without making these rows.

    A viewer counts as often as it has active subscriptions, and at least once.
    """
    copies = subs.where("is_active").where(F.col("user_id").isNotNull()).groupBy("user_id").agg(_rows().alias("copies"))
    engaged = _with_recency(vw_user_engagement(watch), as_of).select("user_id", "churn_risk")
    return (
        engaged.join(copies, "user_id", "left")
        .groupBy("churn_risk")
        .agg(F.sum(F.coalesce("copies", F.lit(1))).alias("users"))
    )


def kpi_churn_active_subscribers(watch: DataFrame, subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Recency and churn risk of active subscribers, one row each.

    A subscriber that never watched has no risk; a subscription without a user is no subscriber.
    ``subs`` must be cleaned.
    """
    subscribers = subs.where("is_active").where(F.col("user_id").isNotNull()).select("user_id").distinct()
    last_watch = watch.groupBy("user_id").agg(F.max("watch_date").alias("last_watch_date"))
    return _with_recency(subscribers.join(last_watch, "user_id", "left"), as_of, strict=True)


def kpi_churn_distribution(churn: DataFrame) -> DataFrame:
    """Rows of a churn list per risk: viewers, or subscriptions if it repeats viewers."""
    return churn.groupBy("churn_risk").agg(_rows().alias("users"))


def kpi_user_top_genres(
    watch: DataFrame,
    movies: DataFrame,
    k: int = 5,
    how: str = "inner",
    ordered: bool = False,
    slots: int = 1,
    titled: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` genres that each viewer watched most often.

    Views of one title by one viewer are counted before the join, which so sees each pair once,
    however often a title was watched by viewers that nobody knows. The last shuffle carries
    at most one row per viewer and genre; a viewer has few genres, so none is heavy. The NULL
    viewer is one viewer with as many rows as there are genres. For ``slots`` see ``lookup``.

    ``titled`` are the same events with their ``primary_genre``, if a join (with the same ``how``) was stored
    before: then viewers and genres are counted in the map tasks, and nothing is joined.
    """
    if titled is None:
        pairs = watch.groupBy("user_id", "show_id").agg(_rows().alias("views"))
        found = lookup(pairs, movies.select("show_id", "primary_genre"), "show_id", how, slots)
        genre_views = F.sum("views")
    else:
        found, genre_views = titled, _rows()
    counts = found.groupBy("user_id", "primary_genre").agg(genre_views.alias("genre_view_count"))
    favourites = Window.partitionBy("user_id").orderBy(_desc("genre_view_count"), _asc("primary_genre"))
    top = counts.withColumn("genre_rank", F.row_number().over(favourites)).where(F.col("genre_rank") <= k)
    return _report(top, [_asc("user_id"), _asc("genre_rank")], None, ordered)


def kpi_avg_watch_per_user(watch: DataFrame, digits: int = 1) -> DataFrame:
    """Mean and median of the minutes that a viewer watched in all; one row."""
    per_user = (
        watch.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.coalesce(F.sum(MINUTES), F.lit(0)).alias("minutes"))
    )
    return mean_and_median(per_user, "minutes", digits).withColumnsRenamed(
        {"n": "viewers", "mean": "mean_watch_minutes", "median": "median_watch_minutes"}
    )
