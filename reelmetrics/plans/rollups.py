"""The three views, kept up to date from partial sums.

Facts are stored by period (month or day) and so are their sums by title, by viewer and by plan. Counts,
sums and maxima can be merged, so a view adds up the sums of the periods and reads no fact. When events
arrive late, only the periods they fall into are read and summed again; all others keep their sums.

A batch goes through in four steps: its periods are noted as due, its rows are appended, the due
periods are summed again, the note is deleted. Sums are always formed from all rows of a period, so
summing twice does no harm: after a failure, ``refresh`` carries on with what is due.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelmetrics.functions import month_key
from reelmetrics.plans.kpi import MINUTES
from reelmetrics.sources import files
from reelmetrics.sources.writers import write_curated

PERIOD = "period"
#: How a period is named, from a date.
PERIODS = {"month": month_key, "day": lambda day: F.date_format(day, "yyyy-MM-dd")}


def _sums() -> dict[str, tuple[str, dict[str, Column], dict[str, Column]]]:
    """By name of the sums: the key, the sums of rows, and how these are merged."""
    rows = F.count(F.lit(1))
    return {
        "by_show": (
            "show_id",
            {"views": rows, "minutes": F.sum(MINUTES)},
            {"total_views": F.sum("views"), "total_watch_minutes": F.sum("minutes")},
        ),
        "by_user": (
            "user_id",
            {"sessions": rows, "minutes": F.sum(MINUTES), "last_date": F.max("watch_date")},
            {"total_sessions": F.sum("sessions"), "total_watch_minutes": F.sum("minutes"), "last_watch_date": F.max("last_date")},
        ),
        "by_plan": (
            "plan_id",
            {"subs": rows, "revenue": F.sum("monthly_revenue")},
            {"subscription_count": F.sum("subs"), "total_revenue": F.sum("revenue")},
        ),
    }


# The date that gives the period of a fact, and the sums that are kept of it.
FACTS = {"watch": ("watch_date", ("by_show", "by_user")), "subscriptions": ("start_date", ("by_plan",))}


def _periods(named: DataFrame) -> list[str | None]:
    """The periods that occur; a pass over the rows observes them, and sends a list per task."""
    seen = Observation()
    known, undated = F.to_json(F.collect_set(PERIOD)).alias("known"), F.count_if(F.col(PERIOD).isNull()).alias("undated")
    named.select(PERIOD).observe(seen, known, undated).write.format("noop").mode("overwrite").save()
    return sorted(json.loads(seen.get["known"])) + [None] * (seen.get["undated"] > 0)


class RollupStore:
    """Facts and their sums below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, period: str = "month"):
        if period not in PERIODS:
            raise ValueError(f"period is one of {', '.join(PERIODS)}, not {period!r}")
        self.spark, self.folder, self.period = spark, folder.rstrip("/"), period

    # -- writing -----------------------------------------------------------------------

    def add(self, fact: str, rows: DataFrame) -> list[str | None]:
        """Append rows to a fact and bring the sums of their periods up to date.

        Returns the periods, of which NULL is one for rows without a date. ``rows`` is computed twice,
        once for its periods, so it should be a stored batch.
        """
        named = rows.withColumn(PERIOD, PERIODS[self.period](F.col(FACTS[fact][0])))
        periods = _periods(named)
        note = f"{self.folder}/due/{uuid.uuid4().hex}.json"
        files.create_text(self.spark, note, json.dumps({"fact": fact, "periods": periods}))
        named.hint("rebalance", PERIOD).write.mode("append").partitionBy(PERIOD).parquet(f"{self.folder}/{fact}")
        self._sum_up(fact, periods)
        files.delete(self.spark, note)
        return periods

    def refresh(self) -> dict[str, list[str | None]]:
        """Finish batches that failed on the way; returns the periods that were due, by fact."""
        due: dict[str, list[str | None]] = {}
        notes = [n for n in files.list_names(self.spark, f"{self.folder}/due") if n.endswith(".json") and not n.startswith(".")]
        for name in notes:
            note = json.loads(files.read_text(self.spark, f"{self.folder}/due/{name}"))
            due.setdefault(note["fact"], []).extend(p for p in note["periods"] if p not in due.get(note["fact"], []))
        for fact, periods in due.items():
            self._sum_up(fact, periods)
        for name in notes:
            files.delete(self.spark, f"{self.folder}/due/{name}")
        return due

    def _sum_up(self, fact: str, periods: Sequence[str | None]) -> None:
        if not files.list_names(self.spark, f"{self.folder}/{fact}"):
            return
        rows = self.periods_of(fact, periods)
        for name in FACTS[fact][1]:
            key, sums, _ = _sums()[name]
            summed = rows.groupBy(PERIOD, key).agg(*[c.alias(n) for n, c in sums.items()])
            write_curated(summed, f"{self.folder}/{name}", [PERIOD], dynamic=True)

    # -- reading -----------------------------------------------------------------------

    def fact(self, name: str) -> DataFrame:
        return self._read(name)

    def periods_of(self, fact: str, periods: Sequence[str | None]) -> DataFrame:
        """The rows of some periods; no file of another period is opened."""
        known = [p for p in periods if p is not None]
        chosen = F.col(PERIOD).isin(known) if known else F.lit(False)
        return self._read(fact).where(chosen | F.col(PERIOD).isNull() if None in periods else chosen)

    def _read(self, name: str) -> DataFrame:
        # The name of a period is text; without a schema it might be read as a number or a date.
        path = f"{self.folder}/{name}"
        fields = [f for f in self.spark.read.parquet(path).schema.fields if f.name != PERIOD]
        return self.spark.read.schema(StructType([*fields, StructField(PERIOD, StringType())])).parquet(path)

    def merged(self, name: str, since: str | None = None, until: str | None = None) -> DataFrame:
        """The sums of all periods, or of those from ``since`` to ``until``, by key."""
        key, _, merge = _sums()[name]
        sums = self._read(name)
        if since is not None:
            sums = sums.where(F.col(PERIOD) >= since)
        if until is not None:
            sums = sums.where(F.col(PERIOD) <= until)
        return sums.groupBy(key).agg(*[c.alias(n) for n, c in merge.items()])

    def vw_top_watched_titles(self, movies: DataFrame, **periods: str) -> DataFrame:
        titles = movies.select("show_id", "title", "type", "primary_genre")
        totals = ["total_views", "total_watch_minutes"]
        return self.merged("by_show", **periods).join(titles, "show_id").select(*titles.columns, *totals)

    def vw_user_engagement(self, **periods: str) -> DataFrame:
        return self.merged("by_user", **periods)

    def vw_revenue_by_plan(self, plans: DataFrame, **periods: str) -> DataFrame:
        totals = self.merged("by_plan", **periods).join(plans.select("plan_id", "plan_name"), "plan_id")
        return totals.groupBy("plan_name").agg(
            F.sum("subscription_count").alias("subscription_count"), F.sum("total_revenue").alias("total_revenue")
        )

    def create_views(self, prefix: str = "") -> list[str]:
        """Store the three views in the catalog, over tables of the sums; returns their names.

        The tables ``{prefix}movies`` and ``{prefix}plans`` must be there. Call it again after
        a batch that brings new periods, so that the catalog learns of them.
        """
        for name in _sums():
            if files.list_names(self.spark, f"{self.folder}/{name}"):
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} USING parquet LOCATION '{self.folder}/{name}'")
                self.spark.sql(f"MSCK REPAIR TABLE {prefix}{name}")
                self.spark.catalog.refreshTable(f"{prefix}{name}")
        names = []
        for view, query in ROLLUP_VIEWS.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {prefix}{view} AS {query.format(p=prefix)}")
            names.append(prefix + view)
        return names

    def drop_views(self, prefix: str = "") -> None:
        """Drop views and tables of ``create_views``; the files stay."""
        for view in ROLLUP_VIEWS:
            self.spark.sql(f"DROP VIEW IF EXISTS {prefix}{view}")
        for name in _sums():
            self.spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")


# Names and columns of the three stored views.
ROLLUP_VIEWS = {
    "vw_TopWatchedTitles": """
        SELECT m.show_id, m.title, m.type, m.primary_genre, s.views AS total_views, s.minutes AS total_watch_minutes
        FROM (SELECT show_id, sum(views) AS views, sum(minutes) AS minutes FROM {p}by_show GROUP BY show_id) s
        JOIN {p}movies m ON m.show_id = s.show_id""",
    "vw_RevenueByPlan": """
        SELECT p.plan_name, sum(s.subs) AS subscription_count, sum(s.revenue) AS total_revenue
        FROM (SELECT plan_id, sum(subs) AS subs, sum(revenue) AS revenue FROM {p}by_plan GROUP BY plan_id) s
        JOIN {p}plans p ON p.plan_id = s.plan_id
        GROUP BY p.plan_name""",
    "vw_UserEngagement": """
        SELECT user_id, sum(sessions) AS total_sessions, sum(minutes) AS total_watch_minutes, max(last_date) AS last_watch_date
        FROM {p}by_user GROUP BY user_id""",
}
