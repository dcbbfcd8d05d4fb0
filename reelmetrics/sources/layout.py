"""Files in which rows with near values of several columns lie together.

Within a partition, rows are laid out along a space-filling curve: each column is cut into ranges with
about equally many rows, and the bits of the range numbers are interleaved. A file then covers a small
box of all columns, its statistics tell which, and a query on any one of the columns skips most files.
Sorted by one column, as usual, files would cover the whole range of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

from reelmetrics.functions import free_names

#: Ranges per column: 2 to the power of this.
BITS = 8
#: The letters of a text, behind the beginning that all texts share, that count for its range.
LETTERS = 6


def _as_number(df: DataFrame, col: str, shared: str | None) -> Column:
    """A number that grows with the value of a column; two values may share one."""
    value, dtype = F.col(f"`{col}`"), df.schema[col].dataType
    if isinstance(dtype, NumericType):
        return value.cast("double")
    if isinstance(dtype, DateType):
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(dtype, TimestampType):
        return value.cast("double")
    if isinstance(dtype, StringType):
        # Parquet compares texts by their bytes; so do these digits of base 256.
        rest = F.rpad(F.hex(F.substr(value.cast("binary"), F.lit(len((shared or "").encode()) + 1), F.lit(LETTERS))), 2 * LETTERS, "0")
        return F.conv(rest, 16, 10).cast("double")
    raise TypeError(f"{col}: no layout by {dtype.simpleString()}")


def _shared_beginning(low: str | None, high: str | None) -> str:
    """What all texts between two texts begin with."""
    n = 0
    while low and high and n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return (low or "")[:n]


def _observed(df: DataFrame, totals: Sequence[Column]) -> dict[str, Any]:
    """Totals over all rows by name; the one row that holds them is observed."""
    seen, row = Observation(), df.agg(*totals)
    row.observe(seen, *[F.any_value(c).alias(c) for c in row.columns]).write.format("noop").mode("overwrite").save()
    return seen.get


def range_bounds(df: DataFrame, cols: Sequence[str], bits: int = BITS, accuracy: int = 10_000) -> dict[str, tuple[str | None, list[float]]]:
    """The bounds of 2^bits ranges of each column with about equally many rows.

    Quantiles come from sketches that are merged over the tasks; the driver gets 2^bits numbers
    per column. A value that very many rows share fills several ranges and has one of them.
    """
    texts = [c for c in cols if isinstance(df.schema[c].dataType, StringType)]
    shared: dict[str, str] = {}
    if texts:
        ends = _observed(df, [f(F.col(f"`{c}`")).alias(f"{f.__name__}_{i}") for i, c in enumerate(texts) for f in (F.min, F.max)])
        shared = {c: _shared_beginning(ends[f"min_{i}"], ends[f"max_{i}"]) for i, c in enumerate(texts)}
    shares = [k / 2**bits for k in range(1, 2**bits)]
    quantiles = _observed(
        df, [F.percentile_approx(_as_number(df, c, shared.get(c)), shares, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]
    )
    return {c: (shared.get(c), sorted(set(quantiles[f"q{i}"] or []))) for i, c in enumerate(cols)}


def _range_number(value: Column, bounds: Sequence[float]) -> Column:
    """How many bounds a value reaches; missing values come first. A search tree of comparisons."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(value >= bounds[middle - 1], search(middle, high)).otherwise(search(low, middle - 1))

    return F.when(value.isNull(), 0).otherwise(search(0, len(bounds)))


def with_curve_place(
    df: DataFrame, cols: Sequence[str], bounds: dict[str, tuple[str | None, list[float]]], name: str, bits: int = BITS
) -> DataFrame:
    """Add the place of each row on the curve: the bits of its range numbers in turn, highest first."""
    numbers = free_names(df, *[f"range_{i}" for i in range(len(cols))])
    ranged = df.withColumns({n: _range_number(_as_number(df, c, bounds[c][0]), bounds[c][1]) for n, c in zip(numbers, cols)})
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, number in enumerate(numbers):
            one = F.shiftright(F.col(number).cast("bigint"), bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(cols) + len(cols) - 1 - k))
    return ranged.withColumn(name, place).drop(*numbers)


def write_clustered(
    df: DataFrame, path: str, cluster_by: Sequence[str], partition_cols: Sequence[str] = (), files: int = 200, bits: int = BITS
) -> int:
    """Overwrite a Parquet dataset, laid out along the curve within its partitions; returns its rows.

    Rows are dealt by ranges of partition, place on the curve and a hash of all columns. So a value that
    most rows share is cut into several files by the other columns, and rows that are equal in
    all of ``cluster_by`` by the hash. ``files`` is about the number of files: choose it so that one has some
    hundred megabytes. ``df`` is read three times (twice without texts in ``cluster_by``).
    """
    if len(cluster_by) * bits > 62:
        raise ValueError("at most 62 bits for all columns together")
    bounds = range_bounds(df, cluster_by, bits)
    place, mixed = free_names(df, "place", "mixed")
    placed = with_curve_place(df.withColumn(mixed, F.xxhash64(*df.columns)), cluster_by, bounds, place, bits)
    keys = [*partition_cols, place]
    written = Observation()
    dealt = placed.repartitionByRange(files, *keys, mixed).sortWithinPartitions(*keys).drop(place, mixed)
    writer = dealt.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return written.get["rows"]
