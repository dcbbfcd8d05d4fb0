"""Rules on keys where tables are large: few bytes are shuffled for each key, and each table is read once.

``dq_primary_key`` and ``dq_foreign_key`` shuffle every key. Here a sieve tells first which keys
can be doubled at all, and all foreign keys of a table leave it in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from reelmetrics.functions import free_names
from reelmetrics.operators.quality import dq_primary_key
from reelmetrics.sources.writers import write_curated

#: A list of hashes up to this length (8 bytes each) is broadcast.
FEW_HASHES = 1_000_000


def _doubled_ranges(df: DataFrame, key: str) -> DataFrame:
    """Ranges of 32,768 ids in which there are more rows than different ids.

    Each task forms one bitmap per range of ids that it meets; united bitmaps have a bit per different id.
    Ids that are numbered through, and stored about in that order, shuffle less than a bit per row.
    """
    value = F.col(f"`{key}`").cast("bigint")
    return (
        df.where(value.isNotNull())
        .groupBy(F.bitmap_bucket_number(value).alias("id_range"))
        .agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value))).alias("ids"))
        .where("rows > ids")
        .select("id_range")
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str], sieve: str | None = None) -> DataFrame:
    """The rows of ``dq_primary_key``: key values that are missing or occur more than once, with their rows.

    Only keys that pass a sieve are grouped. For one integer key the sieve is a bitmap of the ids in each
    range of them: where it has as many bits as rows, no id is doubled. For other keys it is a 64-bit hash, which
    is grouped in place of the key, however wide that is, and leaves the keys whose hash occurs
    twice. Both only let through too much, so the result is exact. ``sieve`` (``ids`` or ``hash``)
    overrides the choice; ids with large gaps are better off with the hash.
    """
    keys = [key] if isinstance(key, str) else list(key)
    one_id = len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, IntegralType)
    sieve = sieve or ("ids" if one_id else "hash")
    if sieve not in ("ids", "hash") or sieve == "ids" and not one_id:
        raise ValueError("sieve is 'hash', or 'ids' for one integer key")
    named = [F.col(f"`{k}`") for k in keys]
    if sieve == "ids":
        passed = F.bitmap_bucket_number(named[0].cast("bigint"))
        found = _doubled_ranges(df, keys[0]).withColumnRenamed("id_range", "_sieve")
    else:
        passed = F.xxhash64(*named)
        found = df.groupBy(passed.alias("_sieve")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_sieve")
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in named])
    suspects = df.select(*named).where(~missing).withColumn("_sieve", passed).join(found, "_sieve", "left_semi").drop("_sieve")
    doubled = dq_primary_key(suspects, keys)
    absent = df.select(*named).where(missing).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return doubled.unionByName(absent)


def rows_by_wide_key(rows: DataFrame, key: str, folder: str, few: int = FEW_HASHES) -> DataFrame:
    """``key, rows``: how often each value of a wide column occurs, where most occur once.

    Behind a sieve as in ``duplicate_keys``, so that texts are not shuffled: a 64-bit hash of each is counted, the hashes that
    occur twice or more are written to ``folder``, which all executors share, and rows with other hashes
    are counted as they are read. With more than ``few`` such hashes, which are broadcast, all rows are grouped.
    The result is exact in both cases. ``rows`` is computed twice, so it should be stored.
    """
    sieve, n = free_names(rows, "sieve", "n")
    hashed = rows.select(key).withColumn(sieve, F.xxhash64(key))
    doubled = hashed.groupBy(sieve).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(sieve)
    if write_curated(doubled, folder) > few:
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    doubled = F.broadcast(rows.sparkSession.read.schema(doubled.schema).parquet(folder))
    once = hashed.join(doubled, sieve, "left_anti").select(key, F.lit(1).cast("bigint").alias("rows"))
    grouped = hashed.join(doubled, sieve, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return once.unionByName(grouped)


def orphan_keys(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[tuple[str, str, str]], parent_keys: Mapping[str, str] | None = None
) -> DataFrame:
    """``child, key, parent, value, rows``: key values that a parent does not have, for many rules at once.

    A rule is ``(child, key column, parent)``; the parent's column has the same name unless ``parent_keys``
    gives another one for its table. Each table is read once, whatever the number of its rules: a child row
    gives one value per rule, tagged by a number, which are counted in the map tasks, and one join meets the
    tagged values of all parents. Values are compared in the type of the parent's column, as integers if
    all these columns are, otherwise as text, and returned as text. A missing key is not a violation. Rules on tables or columns that are
    not there are left out; so are two rules that are the same.
    """
    def parent_key(key: str, parent: str) -> str:
        return (parent_keys or {}).get(parent, key)

    rules = [
        (child, key, parent)
        for child, key, parent in dict.fromkeys(foreign_keys)
        if child in tables and parent in tables and key in tables[child].columns and parent_key(key, parent) in tables[parent].columns
    ]
    if not rules:
        raise ValueError("none of the foreign keys is on tables that are given")

    # A number stands for a rule, and one for a parent's column. Integers stay integers until they are counted
    # and met: a map task holds an entry for each of its keys, so a narrow one bounds its memory.
    columns = list(dict.fromkeys((parent, parent_key(key, parent)) for _, key, parent in rules))
    types = {(parent, name): tables[parent].schema[name].dataType for parent, name in columns}
    held_as = "bigint" if all(isinstance(t, IntegralType) for t in types.values()) else "string"

    # Values by child table: one array per row with an entry for each rule.
    used = []
    for child in dict.fromkeys(c for c, _, _ in rules):
        entries = [
            F.struct(
                F.lit(number).alias("rule"),
                F.col(f"`{key}`").cast(types[parent, parent_key(key, parent)]).cast(held_as).alias("value"),
            )
            for number, (c, key, parent) in enumerate(rules)
            if c == child
        ]
        used.append(tables[child].select(F.inline(F.array(*entries))))
    counted = (
        reduce(DataFrame.unionByName, used)
        .where(F.col("value").isNotNull())
        .groupBy("rule", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    held = []
    for parent in dict.fromkeys(p for _, _, p in rules):
        entries = [
            F.struct(F.lit(number).alias("column"), F.col(f"`{name}`").cast(held_as).alias("value"))
            for number, (p, name) in enumerate(columns)
            if p == parent
        ]
        held.append(tables[parent].select(F.inline(F.array(*entries))))
    # An outer join, as an anti join would be pushed below the counting, once for each child.
    known = reduce(DataFrame.unionByName, held).where(F.col("value").isNotNull()).withColumn("known", F.lit(True))
    column = F.element_at(F.array(*[F.lit(columns.index((p, parent_key(key, p)))) for _, key, p in rules]), F.col("rule") + 1)
    met = counted.withColumn("column", column).join(known, ["column", "value"], "left").where(F.col("known").isNull())

    def named(place: int) -> Column:
        return F.element_at(F.array(*[F.lit(rule[place]) for rule in rules]), F.col("rule") + 1)

    return met.select(
        named(0).alias("child"), named(1).alias("key"), named(2).alias("parent"), F.col("value").cast("string").alias("value"), "rows"
    )
