"""Exact copies: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import lower_ascii, stored, whole_text

#: A list of repeated hashes up to this length (16 bytes each) is broadcast.
BROADCAST_HASHES = 1_000_000


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _elected(keep: str) -> Column:
    """The kept row of a group as a struct; ids come before null, a row number settles ties."""
    if keep == "smallest":
        return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    if keep == "largest":
        return F.max(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "row"))
    raise ValueError("keep is 'smallest' or 'largest'")


def copy_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    content_hash: Callable[[Column], Column] = _md5,
    broadcast_hashes: int = BROADCAST_HASHES,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are identical after A-Z became small letters. Rows are
    grouped by a 128-bit hash; then the least and the greatest text of every group of two or
    more are compared, which finds any collision. A group that collides is grouped by its
    whole texts instead. A hot group is combined in the map tasks: each sends two texts.

    Null text equals the empty text. Exactly one row of a group is kept: that with the smallest
    (or largest) id, an id before null; of repeated rows with that id, any one. ``keep_id`` is
    null if no row of the group has an id. An empty table gives an empty result. Other columns
    are not read.
    """
    spark = docs.sparkSession
    text = lower_ascii(whole_text(text_col))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", content_hash(F.col("text")).alias("hash")
    )
    rows = stored(
        texts.select("doc_id", "hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))
        .withColumn("row", F.monotonically_increasing_id()),
        "copy-rows",
    )
    groups = stored(
        rows.groupBy("hash").agg(F.count(F.lit(1)).alias("size"), _elected(keep).alias("elected")).filter("size > 1"),
        "copy-groups",
    )
    suspects = texts.select("hash", "text")
    repeated = groups.select("hash")
    if repeated.count() <= broadcast_hashes:
        suspects = suspects.join(F.broadcast(repeated), "hash", "left_semi")
    collided = stored(
        suspects.groupBy("hash").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
        .filter("least != greatest").select("hash"),
        "copy-collisions",
    )
    if collided.isEmpty():
        return _grouped(rows, groups, ["hash"])
    apart = stored(
        texts.join(collided, "hash", "left_semi")
        .withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
        .withColumn("row", F.monotonically_increasing_id()),
        "copy-apart",
    )
    by_text = stored(
        apart.groupBy("hash", "text").agg(F.count(F.lit(1)).alias("size"), _elected(keep).alias("elected")).filter("size > 1"),
        "copy-by-text",
    )
    plain = _grouped(rows.join(collided, "hash", "left_anti"), groups, ["hash"])
    return plain.unionByName(_grouped(apart, by_text, ["hash", "text"]))


def _grouped(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what is known of their group; a row without a group stands alone.

    Both sides are stored tables, so the adaptive skew join splits a hot group.
    """
    found = rows.join(groups, keys, "left")
    alone = F.col("elected").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("elected.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("elected.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents without their exact copies, with all their columns and one row per text.

    Documents are told apart by id and text, null ids included. If an id repeats with one
    text, one of those rows stays. Extra columns pass through under their names.
    """
    groups = stored(copy_groups(docs, id_col, text_col, keep), "copies")
    dropped = groups.filter("NOT kept")
    others = dropped.filter("NOT doc_id <=> keep_id").select(
        F.col("doc_id").alias("__copy_id"), F.col("text_sha256").alias("__copy_sha")
    )
    sha = F.sha2(lower_ascii(whole_text(text_col)).cast("binary"), 256)
    left = docs.withColumn("__sha", sha)
    same = left[f"`{id_col}`"].eqNullSafe(others["__copy_id"]) & (left["__sha"] == others["__copy_sha"])
    left = left.join(others, same, "left_anti")
    if not dropped.filter("doc_id <=> keep_id").isEmpty():
        left = left.dropDuplicates([id_col, "__sha"])
    return left.drop("__sha")
