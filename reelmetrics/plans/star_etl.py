"""From six raw tables to curated datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelmetrics.operators import clean, enrich
from reelmetrics.plans import kpi
from reelmetrics.sources import readers, releases
from reelmetrics.sources.writers import write_curated

# The datasets that are partitioned, and by what.
PARTITIONED = {
    "dim_movies": ["type"],
    "fact_subscriptions": ["status"],
    "watch_enriched": ["watch_year"],
}


def run_pipeline(
    spark: SparkSession,
    src: str | Mapping[str, DataFrame],
    dst: str,
    as_of: dt.date | None = None,
    genres_per_user: int = 5,
    persist: bool = False,
) -> dict[str, int]:
    """Clean, join and summarise; write 14 datasets below ``dst`` and return their rows.

    ``src`` is a folder with the CSV files, or the raw tables by name. ``dst`` must be a
    folder that all executors share.

    The cleaned tables are written first and read back. So the raw input is parsed once,
    each report reads only the columns it needs, and no plan reaches back over the
    cleaning if an executor is lost. Reports on titles, and reports on viewers, share one
    rollup of the events each; with ``persist`` it is cached until they are written. The report on genres
    of viewers counts the stored events that have their titles already. A line of
    a CSV file that does not fit its table is left out; ``run_from_csv`` keeps and counts them.
    """
    if isinstance(src, str):
        return run_from_csv(spark, src, dst, as_of, genres_per_user, persist)[0]
    raw = src
    rows: dict[str, int] = {}

    def put(name: str, df: DataFrame, rebalance: bool | None = None) -> DataFrame:
        path = f"{dst}/{name}"
        rows[name] = write_curated(df, path, PARTITIONED.get(name, ()), False, rebalance)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)

    movies = put("dim_movies", clean.clean_movies(raw["movies"], as_of))
    users = put("dim_users", clean.clean_users(raw["users"]))
    subs = put("fact_subscriptions", clean.clean_subscriptions(raw["subscriptions"], as_of))
    watch = put("fact_watch_history", clean.clean_watch(raw["watch"]).drop("watch_month"))
    ratings = clean.clean_ratings(raw["ratings"])
    plans = raw["plans"]

    # Events are brought together by year while they are narrow, before they get the texts of titles and viewers.
    by_year = clean.add_watch_year(watch).hint("rebalance", "watch_year").drop("watch_year")
    enriched = enrich.watch_enriched(by_year, movies, users)
    enriched = enriched.withColumn("watch_month", kpi.month_key(enriched["watch_date"]))
    enriched = put("watch_enriched", clean.add_watch_year(enriched), rebalance=False)

    by_show, by_user = kpi.views_by_show(watch), kpi.vw_user_engagement(watch)
    if persist:
        by_show.persist()
        by_user.persist()
    try:
        put("kpi_top_watched_titles", kpi.kpi_top_watched_titles(watch, movies, how="left", rollup=by_show))
        put("kpi_popular_genres", kpi.kpi_popular_genres(watch, movies, how="left", rollup=by_show))
        put("kpi_active_cities", kpi.kpi_active_cities(watch, users, how="left", rollup=by_user))
        put("kpi_revenue_by_plan", kpi.kpi_revenue_by_plan(subs, plans, how="left"))
        put("kpi_device_usage", kpi.kpi_device_usage(watch))
        put("kpi_top_rated_movies", kpi.kpi_top_rated(ratings, movies, how="left"))
        put("kpi_monthly_trend", kpi.kpi_monthly_trend(watch))
        put("kpi_user_engagement_churn", kpi.kpi_user_engagement_churn(watch, subs, as_of, rollup=by_user))
        put("kpi_user_recommendation_genres", kpi.kpi_user_top_genres(watch, movies, genres_per_user, how="left", titled=enriched))
    finally:
        by_show.unpersist()
        by_user.unpersist()
    return rows


def publish_run(
    spark: SparkSession,
    src: str | Mapping[str, DataFrame],
    base: str,
    as_of: dt.date | None = None,
    genres_per_user: int = 5,
    persist: bool = False,
) -> int:
    """``run_pipeline`` into a folder of its own below ``base``, then one switch to it.

    Returns the number of the release; ``sources.releases.open_release`` reads it. Until the switch, and if
    the run fails, readers see all datasets of the release before.
    """
    notes = {"as_of": as_of or dt.date.today(), "genres_per_user": genres_per_user}
    return releases.publish(
        spark, base, lambda folder: run_pipeline(spark, src, folder, as_of, genres_per_user, persist), notes
    )


class Account(NamedTuple):
    """What became of the lines of a file: ``read = rejected + filtered + written``.

    For a table that is not written itself (ratings, plans) all but the rejected lines are
    left to the reports, and ``filtered`` and ``written`` are None.
    """

    read: int
    rejected: int
    filtered: int | None
    written: int | None


# The dataset that a raw table is written to.
WRITTEN_AS = {"movies": "dim_movies", "users": "dim_users", "subscriptions": "fact_subscriptions", "watch": "fact_watch_history"}


def run_from_csv(
    spark: SparkSession,
    folder: str,
    dst: str,
    as_of: dt.date | None = None,
    genres_per_user: int = 5,
    persist: bool = False,
) -> tuple[dict[str, int], dict[str, Account]]:
    """``run_pipeline`` over CSV files; lines that do not fit their table go to ``dst/rejected/<table>``.

    Returns the rows of the datasets and an account of the lines of each file. The write of
    the rejected lines counts both them and all lines read, which costs one more pass over a file.
    """
    accepted, lines = {}, {}
    for table, df in readers.read_star(spark, folder, keep_rejects=True).items():
        every = Observation()
        _, rejected = readers.split_rejects(df.observe(every, F.count(F.lit(1)).alias("rows")))
        dropped = write_curated(rejected, f"{dst}/rejected/{table}")
        lines[table] = (every.get["rows"], dropped)
        accepted[table] = readers.split_rejects(df)[0]
    rows = run_pipeline(spark, accepted, dst, as_of, genres_per_user, persist)
    accounts = {}
    for table, (read, dropped) in lines.items():
        written = rows[WRITTEN_AS[table]] if table in WRITTEN_AS else None
        accounts[table] = Account(read, dropped, None if written is None else read - dropped - written, written)
    return rows, accounts


def star_views(tables: Mapping[str, DataFrame], how: str = "left") -> dict[str, DataFrame]:
    """The named views for SQL in a session, from cleaned tables; see ``register_views``."""
    return {
        "watch_enriched": enrich.watch_enriched(tables["watch"], tables["movies"], tables["users"], how),
        "subs_enriched": enrich.subs_enriched(tables["subscriptions"], tables["plans"], tables["users"], how),
        "ratings_enriched": enrich.ratings_enriched(tables["ratings"], tables["movies"], how),
        "dim_movies": tables["movies"],
    }
