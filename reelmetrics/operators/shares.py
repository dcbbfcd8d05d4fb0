"""Shares of a total, and counts presented in a fixed order of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions import percent_of, require_exact


def share_of_total(df: DataFrame, key: str, measure: str, digits: int = 1) -> DataFrame:
    """Add ``share_pct``, the share of each key in the sum of ``measure``.

    A row without a key takes no part. The total is a scalar subquery over the sums by key:
    no window gathers the keys in one task, and the sums are computed once, as Spark reuses
    their shuffle. The measure is an integer or a decimal; if its sum is 0 the shares are NULL.
    """
    require_exact(df, measure)
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias(measure))
    whole = per_key.agg(F.sum(measure)).scalar()
    return per_key.withColumn("share_pct", percent_of(F.col(measure), whole, digits))


def ordered_counts(df: DataFrame, col: str, categories: Sequence[str], count_name: str = "rows") -> DataFrame:
    """Rows per category with the place of the category; an absent one counts 0."""
    listed = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in categories])).alias("position", col)
    )
    counted = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return listed.join(counted, col, "left").select(
        "position", col, F.coalesce(F.col(count_name), F.lit(0)).alias(count_name)
    )
