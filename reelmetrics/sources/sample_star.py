"""The six tables, taken from a star schema of parts, customers, orders and line items.

Each table is one projection, with at most one join, over Parquet files, so columns that
a query does not use are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SampleStar:
    """Raw (not yet cleaned) tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def parquet(self, name: str) -> DataFrame:
        """A source table; its schema is read from the files once."""
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def movies(self) -> DataFrame:
        """Titles; some have no director, some no country."""
        return self.parquet("part").selectExpr(
            "p_partkey AS show_id",
            "CASE WHEN p_size <= 25 THEN 'Movie' ELSE 'TV Show' END AS type",
            "p_name AS title",
            "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS director",
            "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS primary_country",
            "1952 + p_size AS release_year",
            "p_type AS primary_genre",
        )

    def movies_with_copies(self) -> DataFrame:
        """Every title twice, with blanks around its name, once in capital letters."""
        movies = self.movies().withColumn("title", F.concat(F.lit("  "), "title", F.lit(" ")))
        return movies.unionByName(movies.withColumn("title", F.upper("title")))

    def users(self) -> DataFrame:
        nations = self.parquet("nation").join(
            self.parquet("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.parquet("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey AS user_id",
                "c_name AS name",
                "CAST(floor((c_acctbal + 1000) / 100) AS INT) AS age",
                "n_name AS city",
                "r_name AS country",
            )
        )

    def plans(self) -> DataFrame:
        return (
            self.parquet("orders")
            .selectExpr(
                "CAST(substr(o_orderpriority, 1, 1) AS INT) AS plan_id",
                "substr(o_orderpriority, 3) AS plan_name",
            )
            .distinct()
        )

    def subscriptions(self) -> DataFrame:
        """Subscriptions; the status is not uniform yet."""
        return self.parquet("orders").selectExpr(
            "o_orderkey AS subscription_id",
            "o_custkey AS user_id",
            "CAST(substr(o_orderpriority, 1, 1) AS INT) AS plan_id",
            "CAST(o_orderdate AS DATE) AS start_date",
            "CASE WHEN o_orderstatus = 'F' THEN date_add(CAST(o_orderdate AS DATE), 180) END AS end_date",
            "CASE WHEN o_orderstatus = 'O' THEN ' aCTIVE ' ELSE 'cancelled' END AS status",
            "CAST(o_totalprice AS DECIMAL(8,2)) AS monthly_revenue",
        )

    def _line_items(self, with_user: bool) -> DataFrame:
        lines = self.parquet("lineitem")
        if not with_user:
            return lines.withColumn("o_custkey", F.lit(None).cast("bigint"))
        orders = self.parquet("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    def watch(self, with_user: bool = True) -> DataFrame:
        """Watch events. The viewer comes from the order of the line item.

        Every line item is one event, with or without its order, so a query that does not
        ask who watched can leave out the join with ``with_user=False``.
        """
        return self._line_items(with_user).selectExpr(
            "o_custkey AS user_id",
            "l_partkey AS show_id",
            "concat(l_returnflag, l_linestatus) AS device",
            "CAST(l_shipdate AS DATE) AS watch_date",
            "CAST(l_quantity - 1 AS DECIMAL(8,1)) AS watch_duration_minutes",
            "CAST(l_discount * 1200 - 5 AS DECIMAL(5,1)) AS completion_pct",
        )

    def ratings(self, with_user: bool = True) -> DataFrame:
        return self._line_items(with_user).selectExpr(
            "o_custkey AS user_id", "l_partkey AS show_id", "l_linenumber AS rating"
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "movies": self.movies(),
            "users": self.users(),
            "plans": self.plans(),
            "subscriptions": self.subscriptions(),
            "watch": self.watch(),
            "ratings": self.ratings(),
        }
