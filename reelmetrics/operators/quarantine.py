"""Rows that break a declared rule, set aside with the names of the rules.

Every rule on rows gets a number. One pass computes for each row a bitmap of the rules that it breaks;
rows with an empty one are good. Reports only count the broken rules; here the rows can be looked at,
mended and loaded again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reelmetrics.operators.quality import TextLimit, decimal_misfits, too_long

#: Rules per bitmap; further ones go to a second, and so on.
RULES_PER_BITMAP = 63
BROKEN, STATE = "broken_rules", "row_state"


class Rule(NamedTuple):
    """A rule on rows: ``kind`` and ``column`` name it, ``broken`` is true for rows that break it."""

    kind: str
    column: str
    broken: Column

    @property
    def name(self) -> str:
        return f"{self.kind}: {self.column}"


def row_rules(
    df: DataFrame,
    required: Sequence[str] = (),
    max_lengths: Mapping[str, int | TextLimit] | None = None,
    decimals: Mapping[str, str] | None = None,
    checks: Sequence[str] = (),
) -> list[Rule]:
    """The declared rules on rows of a table, those on columns that it does not have left out."""
    rules = [Rule("not null", c, F.col(f"`{c}`").isNull()) for c in required if c in df.columns]
    rules += [Rule("max length", c, too_long(c, limit)) for c, limit in (max_lengths or {}).items() if c in df.columns]
    for c, decimal in (decimals or {}).items():
        if c in df.columns:
            out, rounds = decimal_misfits(df, c, decimal)
            rules.append(Rule("decimal", c, out | rounds))
    for expr in checks:
        try:
            df.select(F.expr(expr))
        except AnalysisException:
            continue
        rules.append(Rule("check", expr, ~F.expr(expr)))
    return rules


def rule_bitmaps(rules: Sequence[Rule]) -> list[Column]:
    """Bitmaps of the rules that a row breaks; an unknown result breaks none, as in SQL."""
    bitmaps = []
    for at in range(0, len(rules), RULES_PER_BITMAP):
        bits = F.lit(0).cast("bigint")
        for k, rule in enumerate(rules[at : at + RULES_PER_BITMAP]):
            bits = bits.bitwiseOR(F.when(rule.broken, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
        bitmaps.append(bits)
    return bitmaps


def marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows with ``broken_rules``: the names of the rules that each breaks, in the order of the rules.

    The names are looked up only for rows that break a rule; for the others the array is empty.
    """
    if {BROKEN, STATE} & set(df.columns):
        raise ValueError(f"the table has a column {BROKEN} or {STATE}")
    bitmaps = [f"_bits_{i}" for i in range(-(-len(rules) // RULES_PER_BITMAP))]
    with_bits = df.withColumns(dict(zip(bitmaps, rule_bitmaps(rules)))) if rules else df
    names = [
        F.when(F.col(bitmaps[k // RULES_PER_BITMAP]).bitwiseAND(F.lit(1 << k % RULES_PER_BITMAP)) != 0, rule.name)
        for k, rule in enumerate(rules)
    ]
    none = F.array().cast("array<string>")
    broken = F.filter(F.array(*names), lambda n: n.isNotNull()) if rules else none
    any_bit = F.lit(False)
    for b in bitmaps:
        any_bit = any_bit | (F.col(b) != 0)
    return with_bits.withColumn(BROKEN, F.when(any_bit, broken).otherwise(none)).drop(*bitmaps)


def write_with_quarantine(df: DataFrame, rules: Sequence[Rule], path: str) -> dict[str, int]:
    """Write good rows and, in a partition of their own, the others below ``path``, in one pass.

    ``read_accepted`` and ``read_quarantine`` give both back: the first with the columns of ``df`` alone, the
    second with ``broken_rules`` as well. Returns the rows written to both, and the number of rows that break each rule, counted by
    the write itself. ``df`` is computed once.
    """
    aside = f"_{BROKEN}_aside"
    counted = Observation()
    rows = marked(df, rules).withColumn(aside, F.size(BROKEN) > 0)
    counts = [F.count_if(F.array_contains(BROKEN, rule.name)).alias(f"rule_{k}") for k, rule in enumerate(rules)]
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"), F.count_if(aside).alias("aside"), *counts)
    state = F.when(F.col(aside), "quarantine").otherwise("accepted")
    rows.withColumn(STATE, state).drop(aside).write.mode("overwrite").partitionBy(STATE).parquet(path)
    seen = counted.get
    return {"accepted": seen["rows"] - seen["aside"], "quarantine": seen["aside"]} | {
        rule.name: seen[f"rule_{k}"] for k, rule in enumerate(rules)
    }


def read_accepted(written: DataFrame) -> DataFrame:
    """The good rows of what ``write_with_quarantine`` wrote."""
    return written.where(F.col(STATE) == "accepted").drop(STATE, BROKEN)


def read_quarantine(written: DataFrame) -> DataFrame:
    """The rows set aside, with the names of the rules that they break."""
    return written.where(F.col(STATE) == "quarantine").drop(STATE)


def broken_rule_counts(quarantine: DataFrame) -> DataFrame:
    """``rule, rows`` of the rows set aside."""
    return quarantine.select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))
