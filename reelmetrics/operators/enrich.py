"""Fact tables with the attributes of their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.functions import free_names

# The attributes that each enriched table carries.
TITLE_ATTRIBUTES = ("title", "type", "primary_genre", "release_year")
USER_ATTRIBUTES = ("city", "country", "age_group")
USER_ATTRIBUTES_RAW = ("city", "country", "age", "signup_date")
SUBSCRIBER_ATTRIBUTES = ("city", "country")
RATED_TITLE_ATTRIBUTES = ("title", "primary_genre")


def lookup(fact: DataFrame, dim: DataFrame, on: str, how: str = "left", slots: int = 1) -> DataFrame:
    """Join every row of a fact table to its row in a dimension.

    No broadcast is forced: Spark broadcasts a dimension when its statistics, or its size
    measured at run time, say that it is small. Otherwise both sides are shuffled by the
    key, and a key (or a missing key) that holds a large part of the fact is split by the
    adaptive skew join.

    The adaptive split needs two plain shuffles below the join, as there are for tables
    that were read, filtered, or deduplicated by ``dedup``. It does not act on a dimension
    that was grouped by the key in the same plan, nor with adaptive execution turned off.
    For these cases ``slots`` > 1 spreads the rows of each key over that many slots, by a
    hash of the whole row, and repeats the dimension once per slot. Equal rows share a slot, so
    count them before (as ``kpi_user_top_genres`` does) where they may be many.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if slots == 1:
        return fact.join(dim, on, how)
    (name,) = free_names(fact.select(*fact.columns, *[F.lit(None).alias(c) for c in dim.columns if c not in fact.columns]), "slot")
    slot = F.pmod(F.xxhash64(*fact.columns), F.lit(slots)).cast("int")
    repeated = dim.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return fact.withColumn(name, slot).join(repeated, [on, name], how).drop(name)


def watch_enriched(
    watch: DataFrame,
    movies: DataFrame,
    users: DataFrame,
    how: str = "left",
    user_attributes: Sequence[str] = USER_ATTRIBUTES,
    slots: int = 1,
) -> DataFrame:
    """Watch events with title and viewer attributes.

    Viewers come first, as there are more of them than titles: if only their join has to
    shuffle the events, it does so before title texts make the rows wider.
    """
    known = lookup(watch, users.select("user_id", *user_attributes), "user_id", how, slots)
    titled = lookup(known, movies.select("show_id", *TITLE_ATTRIBUTES), "show_id", how, slots)
    return titled.select(*watch.columns, *TITLE_ATTRIBUTES, *user_attributes)


def subs_enriched(subs: DataFrame, plans: DataFrame, users: DataFrame, how: str = "left", slots: int = 1) -> DataFrame:
    """Subscriptions with plan and subscriber attributes; the few plans are joined last."""
    known = lookup(subs, users.select("user_id", *SUBSCRIBER_ATTRIBUTES), "user_id", how, slots)
    plan_attributes = [c for c in plans.columns if c != "plan_id"]
    return lookup(known, plans, "plan_id", how, slots).select(*subs.columns, *plan_attributes, *SUBSCRIBER_ATTRIBUTES)


def ratings_enriched(ratings: DataFrame, movies: DataFrame, how: str = "left", slots: int = 1) -> DataFrame:
    """Star ratings with title attributes."""
    return lookup(ratings, movies.select("show_id", *RATED_TITLE_ATTRIBUTES), "show_id", how, slots)
