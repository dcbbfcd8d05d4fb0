"""Places of rows within groups, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmetrics.llm.common import stored


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """The rows with ``place``, 0, 1, 2 ... within each group in the given order, and ``n``, the rows of the group. Stored.

    Rows are dealt by ranges of group and order, so a group with most of all rows lies in many
    partitions. A place is the place within the partition plus the rows of the group in
    earlier partitions, which are summed over one row per group and partition. ``group``
    names a column without nulls. Rows that are equal in group and order may swap places. The
    columns ``part``, ``at``, ``first`` and ``before`` must be free.
    """
    dealt = stored(
        df.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}),
        f"{name}-dealt",
    )
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        dealt.groupBy(group, "part")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            group,
            "part",
            "first",
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
            F.sum("rows").over(Window.partitionBy(group)).alias("n"),
        )
    )
    placed = dealt.join(spans, [group, "part"]).withColumn("place", F.col("at") - F.col("first") + F.col("before"))
    return stored(placed.drop("part", "at", "first", "before"), name)
