"""Column expressions shared by the operators. All stay inside code generation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

# Bucket names and edges.
AGE_GROUPS = ("Teen", "Young Adult", "Adult", "Senior")
AGE_EDGES = (18, 30, 45)
AGE_RANGE = (0, 100)
CHURN_RISKS = ("Low", "Medium", "High")
CHURN_EDGES = (30, 60)
CHURN_RANGE = (-1, 100000)

# Factors that turn integers into decimals and leave the digits of decimals as they are.
ONE = Decimal(1)
HUNDRED = Decimal(100)


def as_of_date(as_of: dt.date | None) -> Column:
    """The day that counts as today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def month_key(day: Column) -> Column:
    """Month of a date as text, e.g. ``2024-03``; a missing date stays NULL."""
    return F.date_format(day, "yyyy-MM")


def age_bucket(age: Column, bounds: str = "lt", null_as_senior: bool = False) -> Column:
    """Age group of a viewer.

    ``bounds="lt"``: each group ends before its edge, and the last one is open.
    ``bounds="le"``: each group includes its edge, and an age outside 1..100 has none.
    A missing age has no group, unless ``null_as_senior`` asks for the last one.
    """
    if bounds not in ("lt", "le"):
        raise ValueError(f"bounds must be 'lt' or 'le', not {bounds!r}")
    *younger, oldest = AGE_GROUPS
    lowest, highest = AGE_RANGE
    if bounds == "lt":
        bucket = F.when(age.isNull(), F.lit(None))
        for name, edge in zip(younger, AGE_EDGES):
            bucket = bucket.when(age < edge, name)
        bucket = bucket.otherwise(oldest)
    else:
        bucket = F.when(age <= lowest, F.lit(None))
        for name, edge in zip(younger, AGE_EDGES):
            bucket = bucket.when(age <= edge, name)
        bucket = bucket.when(age <= highest, oldest)
    return F.when(age.isNull(), oldest).otherwise(bucket) if null_as_senior else bucket


def churn_bucket(days: Column, strict: bool = False) -> Column:
    """Churn risk from the days since the last watch.

    By default a missing or negative number of days is ``Low``. With ``strict`` a number
    outside the known range, or a missing one, has no risk.
    """
    low, medium, high = CHURN_RISKS
    medium_after, high_after = CHURN_EDGES
    if not strict:
        return F.when(days > high_after, high).when(days > medium_after, medium).otherwise(low)
    above, up_to = CHURN_RANGE
    known = (days > above) & (days <= up_to)
    return F.when(known, churn_bucket(days))


def clip_percent(pct: Column, clip: str = "upper") -> Column:
    """Limit a percentage to 100 (``upper``) or to 0..100 (``both``); NULL stays NULL."""
    if clip not in ("upper", "both"):
        raise ValueError(f"clip must be 'upper' or 'both', not {clip!r}")
    clipped = F.when(pct > 100, 100)
    if clip == "both":
        clipped = clipped.when(pct < 0, 0)
    return clipped.otherwise(pct)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of a table has, in any spelling."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while f"_{name}" in taken:
            name = f"_{name}"
        names.append(f"_{name}")
    return names


def require_exact(df: DataFrame, col: str) -> None:
    """Refuse a column of floating numbers, whose sums depend on the order of the rows."""
    dtype = df.schema[col].dataType
    if not isinstance(dtype, (DecimalType, IntegralType)):
        raise TypeError(f"{col} must be an integer or a decimal, not {dtype.simpleString()}")


def exact_mean(total: Column, rows: Column, digits: int) -> Column:
    """Mean from an exact (decimal or integer) sum and a row count, rounded half up.

    The quotient is taken in decimals and keeps all digits of the sum, so that a mean that
    lies exactly between two rounded values goes the same way on every run and every
    partitioning. No rows have no mean.
    """
    return F.round(total * F.lit(ONE) / F.nullif(rows, F.lit(0)).cast("decimal(19,0)"), digits)


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """Share in percent, rounded half up, from exact numbers; NULL if the whole is 0."""
    return F.round(part * F.lit(HUNDRED) / F.nullif(whole * F.lit(ONE), F.lit(Decimal(0))), digits)
