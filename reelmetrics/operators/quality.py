"""Data-quality rules and profiles. Each returns a DataFrame.

Rules on rows are counted in one aggregation per table. Rules on keys group by the key before
anything else, so a key with very many rows leaves each map task as one row; each of them
reads its table, but only the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType


def dq_primary_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values that are missing or occur more than once, with their number of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | missing)


def dq_foreign_key(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Key values of ``child`` that ``parent`` does not have, with their number of rows.

    A missing key is not a violation, as in SQL.
    """
    used = child.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(parent_key or on).alias(on)), on, "left_anti")


def dq_check(df: DataFrame, expr: str | Column) -> DataFrame:
    """Rows for which a condition is false; an unknown result passes, as in SQL."""
    return df.where(~(F.expr(expr) if isinstance(expr, str) else expr))


def _per_column(df: DataFrame, cols: Sequence[str], measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Compute ``measures[name][column]`` in one aggregation and list them by column.

    All values must be of type bigint.
    """
    aggs = [measures[m][c].alias(f"{m}:{c}") for c in cols for m in measures]
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{m}:{c}`").alias(m) for m in measures])
            for c in cols
        ]
    )
    return df.agg(*aggs).select(F.inline(entries))


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per required column."""
    return _per_column(df, cols, {"null_count": {c: F.count_if(F.col(c).isNull()) for c in cols}})


class TextLimit(NamedTuple):
    """The longest text that a column may hold, and what its length is counted in.

    ``bytes`` (of UTF-8) is the unit of VARCHAR(n) and ``utf16`` (16-bit units, of which a character
    beyond U+FFFF takes two) that of NVARCHAR(n); ``characters`` are code points.
    """

    most: int
    unit: str = "characters"


def text_length(text: Column, unit: str = "characters") -> Column:
    """The length of a text in the units of ``TextLimit``."""
    if unit == "characters":
        return F.length(text)
    if unit == "bytes":
        return F.octet_length(text)
    if unit == "utf16":
        return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    raise ValueError(f"a length is counted in characters, bytes or utf16, not in {unit}")


def too_long(col: str, limit: int | TextLimit) -> Column:
    """Whether a text exceeds its limit; a number is one of characters."""
    most, unit = limit if isinstance(limit, TextLimit) else TextLimit(limit)
    return text_length(F.col(f"`{col}`").cast("string"), unit) > most


def dq_max_length(df: DataFrame, limits: Mapping[str, int | TextLimit]) -> DataFrame:
    """Longest text and number of texts that are too long, per limited column, in the units of its limit."""
    given = {c: limit if isinstance(limit, TextLimit) else TextLimit(limit) for c, limit in limits.items()}
    return _per_column(
        df,
        list(given),
        {
            "max_length": {c: F.max(F.lit(limit.most).cast("long")) for c, limit in given.items()},
            "longest": {c: F.max(text_length(F.col(f"`{c}`").cast("string"), limit.unit)).cast("long") for c, limit in given.items()},
            "too_long": {c: F.count_if(too_long(c, limit)) for c, limit in given.items()},
        },
    )


def decimal_misfits(df: DataFrame, col: str, decimal: str) -> tuple[Column, Column]:
    """Whether a decimal type cannot hold a value of a column, and whether it would round it.

    Decimals are compared as decimals and texts by their digits, so no digit is too far
    behind the point to count. Only floating numbers are compared as such.
    """
    value, fitted = F.col(f"`{col}`"), F.col(f"`{col}`").try_cast(decimal)
    scale, dtype = int(decimal.rstrip(")").split(",")[1]), df.schema[col].dataType
    if isinstance(dtype, DecimalType):
        loses = F.round(value, scale) != value
    elif isinstance(dtype, IntegralType):
        loses = F.lit(False)
    elif isinstance(dtype, StringType):
        plain = F.regexp_extract(F.trim(value), r"^[+-]?[0-9]*\.?([0-9]*?)0*$", 1)
        other = fitted.cast("double") != value.try_cast("double")
        loses = F.when(F.lower(value).contains("e"), other).otherwise(F.length(plain) > scale)
    else:
        loses = fitted.cast("double") != value.try_cast("double")
    return value.isNotNull() & fitted.isNull(), fitted.isNotNull() & loses


def dq_decimal_fit(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values that a decimal type cannot hold, and values it would round, per column.

    ``types`` maps columns (of numbers or of text) to types such as ``decimal(8,2)``.
    """
    misfits = {c: decimal_misfits(df, c, decimal) for c, decimal in types.items()}
    return _per_column(
        df,
        list(types),
        {
            "out_of_range": {c: F.count_if(out) for c, (out, _) in misfits.items()},
            "rounded": {c: F.count_if(rounds) for c, (_, rounds) in misfits.items()},
        },
    )


def table_row_counts(tables: Mapping[str, DataFrame], with_columns: bool = False) -> DataFrame:
    """One row per table with its number of rows, and of columns if asked for."""
    counts = []
    for name, df in tables.items():
        shape = ["rows", F.lit(len(df.columns)).cast("long").alias("columns")] if with_columns else ["rows"]
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        counts.append(counted.select(F.lit(name).alias("table_name"), *shape))
    return reduce(DataFrame.unionByName, counts)


def dq_row_count(counts: DataFrame, expected: Mapping[str, int], tolerance: float = 0.0) -> DataFrame:
    """Compare row counts with expected ones; ``tolerance`` is a fraction of the expected.

    An expected table that is not among ``counts`` has no rows and is not ok.
    """
    entries = [F.struct(F.lit(t).alias("table_name"), F.lit(n).cast("long").alias("expected")) for t, n in expected.items()]
    wanted = counts.sparkSession.range(1).select(F.inline(F.array(*entries)))
    off = F.abs(F.col("rows") - F.col("expected"))
    return wanted.join(counts, "table_name", "left").select(
        "table_name",
        "expected",
        "rows",
        F.coalesce(off <= F.col("expected") * F.lit(float(tolerance)), F.lit(False)).alias("ok"),
    )


def null_profile(df: DataFrame, k: int | None = 5, cols: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` columns with the most missing values (all columns if ``k`` is None)."""
    ranked = dq_not_null(df, list(cols or df.columns)).orderBy(F.desc("null_count"), F.asc("column_name"))
    return ranked if k is None else ranked.limit(k)


def cleaning_report(before: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Rows before and after each cleaning step, all in one pass.

    A rule is a condition for the rows to keep, or the name of a key column that is to
    become unique. The steps are counted on their own, not one after the other.
    """
    kept = {}
    for step, rule in rules.items():
        if isinstance(rule, str):
            missing = F.max(F.col(rule).isNull().cast("long"))
            kept[step] = F.count_distinct(rule) + F.coalesce(missing, F.lit(0))
        else:
            kept[step] = F.count_if(rule)
    aggs = [F.count(F.lit(1)).alias("before"), *[c.alias(f"after:{s}") for s, c in kept.items()]]
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("step"),
                F.col("before").alias("rows_before"),
                F.col(f"`after:{s}`").alias("rows_after"),
            )
            for s in kept
        ]
    )
    return before.agg(*aggs).select(F.inline(entries))


def constraint_report(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, str],
    foreign_keys: Sequence[tuple[str, str, str]],
    checks: Mapping[str, str],
    required: Mapping[str, Sequence[str]],
    max_lengths: Mapping[str, Mapping[str, int | TextLimit]] | None = None,
    decimals: Mapping[str, Mapping[str, str]] | None = None,
    expected_rows: Mapping[str, int] | None = None,
    tolerance: float = 0.0,
) -> DataFrame:
    """``rule, table_name, column_name, violations, status`` of each declared rule of a set of tables.

    ``violations`` counts rows that break the rule; for an expected number of rows it is the
    number of rows beyond the tolerance. ``status`` is ``ok`` or ``violated``. A rule on a table or
    column that is not present is listed with NULL violations and status ``not checked``. All
    rules on rows of a table are counted in one pass.
    """
    reports, unchecked = [], []

    def listed(counted: DataFrame, rule: str, table: str, column: str | None) -> DataFrame:
        return counted.select(
            F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"), "violations"
        )

    def known(table: str, *cols: str) -> bool:
        return table in tables and set(cols) <= set(tables[table].columns)

    def by_key(rule: str, table: str, key: str, found: DataFrame | None) -> None:
        if found is None:
            unchecked.append((rule, table, key))
        else:
            counted = found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
            reports.append(listed(counted, rule, table, key))

    for table, key in primary_keys.items():
        by_key("primary key", table, key, dq_primary_key(tables[table], key) if known(table, key) else None)
    for table, key, parent in foreign_keys:
        present = known(table, key) and known(parent, key)
        by_key("foreign key", table, key, dq_foreign_key(tables[table], tables[parent], key) if present else None)

    # Rules on rows, by table: (rule, column, rows that break it, or None if that can't be told).
    on_rows: dict[str, list[tuple[str, str, Column | None]]] = {}

    def on_row(rule: str, table: str, column: str, broken: Column | None) -> None:
        on_rows.setdefault(table, []).append((rule, column, broken))

    for table, expr in checks.items():
        on_row("check", table, expr, ~F.expr(expr) if table in tables and _resolves(tables[table], expr) else None)
    for table, cols in required.items():
        for c in cols:
            on_row("not null", table, c, F.col(f"`{c}`").isNull() if known(table, c) else None)
    for table, limits in (max_lengths or {}).items():
        for c, limit in limits.items():
            on_row("max length", table, c, too_long(c, limit) if known(table, c) else None)
    for table, types in (decimals or {}).items():
        for c, decimal in types.items():
            out, rounds = decimal_misfits(tables[table], c, decimal) if known(table, c) else (None, None)
            on_row("decimal", table, c, None if out is None else out | rounds)
    for table in expected_rows or {}:
        on_rows.setdefault(table, [])

    for table, rules in on_rows.items():
        counts = [(rule, c, F.count_if(broken)) for rule, c, broken in rules if broken is not None]
        unchecked += [(rule, table, c) for rule, c, broken in rules if broken is None]
        if table in (expected_rows or {}):
            if table in tables:
                off = F.abs(F.count(F.lit(1)) - F.lit(expected_rows[table]))
                beyond = F.when(off > F.lit(float(expected_rows[table] * tolerance)), off).otherwise(F.lit(0))
                counts.append(("row count", None, beyond))
            else:
                unchecked.append(("row count", table, None))
        if counts:
            aggregated = tables[table].agg(*[n.cast("long").alias(f"_{i}") for i, (_, _, n) in enumerate(counts)])
            entries = [
                F.struct(F.lit(rule).alias("rule"), F.lit(c).cast("string").alias("column_name"), F.col(f"_{i}").alias("violations"))
                for i, (rule, c, _) in enumerate(counts)
            ]
            reports.append(
                aggregated.select(F.inline(F.array(*entries))).select("rule", F.lit(table).alias("table_name"), "column_name", "violations")
            )
    if unchecked:
        spark = next(iter(tables.values())).sparkSession
        schema = "rule string, table_name string, column_name string, violations bigint"
        reports.append(spark.createDataFrame([(*rule, None) for rule in unchecked], schema))
    status = F.when(F.col("violations").isNull(), "not checked").when(F.col("violations") > 0, "violated").otherwise("ok")
    return reduce(DataFrame.unionByName, reports).withColumn("status", status)


def _resolves(df: DataFrame, expr: str) -> bool:
    """Whether a condition uses only columns that a table has."""
    try:
        return bool(df.select(F.expr(expr)).columns)
    except AnalysisException:
        return False
