"""Catalog tables, session views and stored views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.sources import schemas


def create_star_tables(spark: SparkSession, prefix: str = "", location: str | None = None) -> None:
    """Create the six empty Parquet tables anew.

    ``prefix`` goes before each name, e.g. ``"video."`` for a schema. ``location`` is a
    shared folder for the data; without it the tables are kept in the warehouse.
    """
    drop_star_tables(spark, prefix)
    for table in schemas.LOAD_ORDER:
        place = f" LOCATION '{location}/{table}'" if location else ""
        spark.sql(f"CREATE TABLE {prefix}{table} ({schemas.table_columns(table)}) USING parquet{place}")


def drop_star_tables(spark: SparkSession, prefix: str = "") -> None:
    """Drop the six tables where they exist, children first."""
    for table in reversed(schemas.LOAD_ORDER):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{table}")


def load_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    bucket_cols: Sequence[str] = (),
    buckets: int = 0,
    location: str | None = None,
    files_per_bucket: int = 1,
) -> None:
    """Load a table, which is created if it does not exist.

    An existing table keeps its declared columns: values are matched by name and must fit
    them, including the length of its VARCHARs. A new one can be bucketed and sorted by
    the key that it is mostly joined by; tables with the same buckets join without a
    shuffle. Rows are brought together by bucket before, so that a bucket has at most
    ``files_per_bucket`` files: raise it where the rows of a bucket, or of one hot key,
    are too many for one task. Rows that are equal in all columns share a file.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.mode(mode).insertInto(name, overwrite=mode == "overwrite")
        return
    if bucket_cols:
        # Spark deals buckets by this hash, too.
        part = F.pmod(F.hash(*bucket_cols), F.lit(buckets)) * files_per_bucket
        part = part + F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        df = df.repartitionById(buckets * files_per_bucket, part.cast("int"))
    writer = df.write.mode(mode).format("parquet")
    if location:
        writer = writer.option("path", location)
    if bucket_cols:
        writer = writer.bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
    writer.saveAsTable(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Give DataFrames names for SQL in this session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


# Names and columns of the three stored views. Facts are summed by their
# foreign key before the join, as in ``plans.kpi``.
KPI_VIEWS = {
    "vw_TopWatchedTitles": """
        SELECT m.show_id, m.title, m.type, m.primary_genre,
               sum(v.views) AS total_views, sum(v.minutes) AS total_watch_minutes
        FROM (SELECT show_id, count(*) AS views, sum(watch_duration_minutes) AS minutes
              FROM {p}watch GROUP BY show_id) v
        JOIN {p}movies m ON m.show_id = v.show_id
        GROUP BY m.show_id, m.title, m.type, m.primary_genre""",
    "vw_RevenueByPlan": """
        SELECT p.plan_name, sum(s.n) AS subscription_count, sum(s.revenue) AS total_revenue
        FROM (SELECT plan_id, count(*) AS n, sum(monthly_revenue) AS revenue
              FROM {p}subscriptions GROUP BY plan_id) s
        JOIN {p}plans p ON p.plan_id = s.plan_id
        GROUP BY p.plan_name""",
    "vw_UserEngagement": """
        SELECT user_id, count(*) AS total_sessions,
               sum(watch_duration_minutes) AS total_watch_minutes,
               max(watch_date) AS last_watch_date
        FROM {p}watch GROUP BY user_id""",
}


def create_kpi_views(spark: SparkSession, prefix: str = "") -> list[str]:
    """Store the KPI views over the star tables and return their names."""
    names = []
    for view, query in KPI_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{view} AS {query.format(p=prefix)}")
        names.append(prefix + view)
    return names


def drop_kpi_views(spark: SparkSession, prefix: str = "") -> None:
    """Drop the KPI views where they exist."""
    for view in KPI_VIEWS:
        spark.sql(f"DROP VIEW IF EXISTS {prefix}{view}")
