"""Connected components of a graph of links, by rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``); the root is the smallest node.

    Each round links the larger neighbours of a node to its smallest neighbour, then the smaller
    ones, until every component is a star. Links stay spread over the cluster; each round is
    stored, and only counts reach the driver. Loops and repeated links are allowed; nodes may
    not be null. No links give no rows.
    """
    stars = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links"
    )
    state = _state(stars)
    while state[0]:
        stars = stored(_small_star(stored(_large_star(stars), "large-star")), "small-star")
        before, state = state, _state(stars)
        if state == before:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _state(links: DataFrame) -> tuple:
    """A fingerprint of a set of links: a round that leaves it as it is was the last."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Here a > b holds."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    others = links.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()
