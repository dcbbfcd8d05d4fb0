"""Exact mean and median without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from reelmetrics.functions import require_exact

# The 64-bit value is read in three steps of 21 or 22 bits, so no step puts more than
# 2**22 buckets into its window, whatever the number of rows or of distinct values.
_STEPS = (42, 21, 0)


def mean_and_median(values: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """One row ``(n, mean, median)`` for an integer or decimal column; NULLs are skipped.

    The median is the mean of the two middle values. The built-in ``median`` keeps a
    table of all distinct values in one task. Here the two middle ranks are located by a
    histogram of the leading bits, then by a finer one inside the buckets that were hit,
    and so on. Each histogram is formed in the map tasks; a value that very many rows
    share is one bucket. The sides that are broadcast hold two rows, one per middle rank.
    """
    require_exact(values, col)
    dtype = values.schema[col].dataType
    scale = dtype.scale if isinstance(dtype, DecimalType) else 0
    unit = (F.col(col) * F.lit(10**scale)).cast("long")
    units = values.where(F.col(col).isNotNull()).select(unit.alias("unit"))
    rows = F.count(F.lit(1)).alias("n")

    shift = _STEPS[0]
    everything = Window.partitionBy(F.lit(0))
    hist = (
        units.groupBy(F.shiftright("unit", shift).alias("bucket"))
        .agg(rows, F.sum(F.col("unit").cast("decimal(20,0)")).alias("units"))
        .withColumns({"rows": F.sum("n").over(everything), "total": F.sum("units").over(everything)})
        .withColumn("upto", F.sum("n").over(everything.orderBy("bucket")))
    )
    middle = F.array(F.expr("(rows - 1) div 2"), F.expr("rows div 2"))
    hits = hist.select("*", F.posexplode(middle).alias("side", "rank"))
    hits = _hit(hits)

    for finer in _STEPS[1:]:
        hist = (
            units.withColumn("prefix", F.shiftright("unit", shift))
            .join(F.broadcast(hits.withColumnRenamed("bucket", "prefix")), "prefix")
            .groupBy("side", "rank", "rows", "total", F.shiftright("unit", finer).alias("bucket"))
            .agg(rows)
        )
        hist = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("side").orderBy("bucket")))
        hits = _hit(hist)
        shift = finer

    one = F.lit(10**scale).cast("decimal(20,0)")
    whole = F.max("total").cast("decimal(28,0)")
    return hits.agg(
        F.coalesce(F.max("rows"), F.lit(0)).alias("n"),
        F.round(whole / (F.max("rows") * one).cast("decimal(20,0)"), digits).alias("mean"),
        F.round(F.sum("bucket").cast("decimal(24,0)") / (one * F.lit(2)).cast("decimal(20,0)"), digits).alias("median"),
    )


def _hit(hist: DataFrame) -> DataFrame:
    """The bucket that holds each wanted rank, with the rank counted from its start."""
    before = F.col("upto") - F.col("n")
    return hist.where((before <= F.col("rank")) & (F.col("rank") < F.col("upto"))).select(
        "side", (F.col("rank") - before).alias("rank"), "rows", "total", "bucket"
    )


def exact_quantiles(
    values: DataFrame, col: str, shares: Sequence[float | Decimal] = (0.5,), digits: int = 1, accuracy: int = 10_000
) -> DataFrame:
    """``share, n, mean, quantile`` for each share of an integer or decimal column; NULLs are skipped.

    A quantile lies between the two values around the place ``share * (n - 1)`` and is interpolated between
    them, so the share 0.5 gives the median. Two scans: in the first, sketches that are merged over the tasks
    give two values that bracket each place; the second counts the values below a bracket and the
    distinct values inside, in the map tasks. A bracket holds about ``12 / accuracy`` of all rows, or all
    of up to ``accuracy`` rows, which is what the last step sorts per share. Results are exact. Should a sketch be off by more than four
    times what it promises, the query stops with an error; a larger ``accuracy`` then helps.
    No rows give no quantile.
    """
    require_exact(values, col)
    dtype = values.schema[col].dataType
    scale = dtype.scale if isinstance(dtype, DecimalType) else 0
    units = values.where(F.col(col).isNotNull()).select((F.col(col) * F.lit(10**scale)).cast("long").alias("unit"))
    given = [Decimal(str(q)) for q in shares]
    if not given or min(given) < 0 or max(given) > 1:
        raise ValueError("shares lie between 0 and 1, and there is one at least")

    margin = 6 / accuracy
    around = [(float(q) - margin, float(q) + margin) for q in given]
    sketch = F.percentile_approx("unit", [min(max(p, 0.0), 1.0) for pair in around for p in pair], accuracy)
    summary = units.agg(
        F.struct(sketch.alias("at"), F.count(F.lit(1)).alias("n"), F.sum(F.col("unit").cast("decimal(20,0)")).alias("total"))
    ).scalar()

    # NULL stands for all that is below a bracket; it comes first. Few rows need no brackets.
    cells, many = [], F.col("s.n") > accuracy
    for i, (low, high) in enumerate(around):
        below = F.lit(False) if low <= 0 else many & (F.col("unit") < F.col("s.at")[2 * i])
        above = F.lit(False) if high >= 1 else many & (F.col("unit") > F.col("s.at")[2 * i + 1])
        cells.append(F.struct(F.lit(i).alias("i"), F.when(~below, F.col("unit")).alias("cell"), above.alias("above")))
    hist = (
        units.withColumn("s", summary)
        .select(F.inline(F.array(*cells)))
        .where("NOT above")
        .groupBy("i", "cell")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(Window.partitionBy("i").orderBy(F.asc_nulls_first("cell"))))
    )
    share = F.element_at(F.array(*[F.lit(q).cast("decimal(18,17)") for q in given]), F.col("i") + 1)
    wanted = units.sparkSession.range(len(given)).select(F.col("id").cast("int").alias("i"), summary.alias("s"))
    wanted = wanted.select("i", share.alias("share"), "s.n", "s.total", (share * (F.col("s.n") - 1).cast("decimal(19,0)")).alias("place"))
    found = wanted.join(hist, "i", "left")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("rows") <= rank) & (rank < F.col("upto")), F.col("cell")))

    low, high = F.floor("place").cast("long"), F.ceil("place").cast("long")
    ends = found.groupBy("i", "share", "n", "total", "place").agg(value_at(low).alias("low"), value_at(high).alias("high"))
    missed = (F.col("n") > 0) & (F.col("low").isNull() | F.col("high").isNull())
    one = F.lit(10**scale).cast("decimal(20,0)")
    part = (F.col("place") - F.floor("place")).cast("decimal(18,17)")
    between = F.col("low").cast("decimal(19,0)") + (F.col("high") - F.col("low")).cast("decimal(19,0)") * part
    quantile = F.when(missed, F.raise_error(F.lit("a bracket missed its quantile; raise the accuracy"))).otherwise(
        F.round((between / one).cast("decimal(38,12)"), digits)
    )
    mean = F.round(F.col("total").cast("decimal(28,0)") / (F.nullif("n", F.lit(0)) * one).cast("decimal(20,0)"), digits)
    return ends.select("share", F.coalesce("n", F.lit(0)).alias("n"), mean.alias("mean"), quantile.alias("quantile"))
