"""Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_curated(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    dynamic: bool = False,
    rebalance: bool | None = None,
) -> int:
    """Overwrite a Parquet dataset and return its number of rows.

    With partition columns the rows are first rebalanced by them, so a partition gets few
    files of a good size, and the adaptive planner splits a partition that is far larger
    than others. Without them nothing is shuffled; pass ``rebalance=True`` to even out the
    sizes of the files.

    The rows are counted by the write itself, in its last stage: a stage that is run again
    after the loss of an executor lies below the count.

    ``dynamic`` replaces only the partitions that occur in ``df``.
    """
    cols = list(partition_cols)
    if rebalance or (rebalance is None and cols):
        df = df.hint("rebalance", *cols)
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)
    return written.get["rows"]
