"""A Merkle manifest of a dataset by time-forward processing.

A node is named by its label: height, group and place. Processing goes forward in the order of
labels: each node sends its digest to its parent, which is due later. The external queue that
holds what is sent is Spark's sort by the label of the receiver; one round takes all nodes of one
height, so it pops messages in label order and never needs a whole tree in one place. When the
roots are known, a reversed sweep goes from the highest labels to the lowest: a node sends its own
proof to its children, and a child puts its siblings before it. Leaves get the finished proofs.

A run has ``FANOUT`` children at most, so no group grows, whatever the size of a language.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import in_fold, lower_ascii, stored
from reelmetrics.llm.ranking import numbered

# The children of a node, and the fields of a leaf in their order.
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left:string,right:string>>"


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: Sequence[str] = FIELDS, instead: Mapping[str, Column] | None = None) -> Column:
    """SHA-256 of the fields of a row, each as byte count, colon and value, or ``-`` for null.

    ``instead`` gives other values for some fields.
    """
    parts = []
    for name in fields:
        value = (instead or {}).get(name, F.col(f"`{name}`")).cast("string")
        framed = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(framed))
    return _sha256(F.concat(*parts))


def _up(nodes: DataFrame, widest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Deliver digests to parents until each group has one node.

    ``nodes`` are the lowest: ``grp, place, digest, n, item`` with the nodes of the group, ``widest`` at most, and
    what a node stands for. Returns the runs of each height, ``grp, place, run, digest, n`` (``run``: the
    children's digests in order; those of the first height have their ``items``, too), and the last nodes,
    ``grp, digest, height, item``.
    """
    runs: list[DataFrame] = []
    tops = [nodes.filter("n = 1").select("grp", "digest", F.lit(0).alias("height"), "item")]
    none = F.lit(None).cast(nodes.schema["item"].dataType)
    while widest > 1:
        child = ["place", "digest"] if runs else ["place", "digest", "item"]
        parents = (
            nodes.filter("n > 1")
            .groupBy("grp", F.expr(f"place div {FANOUT}").alias("parent"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))
            .agg(F.array_sort(F.collect_list(F.struct(*child))).alias("children"))
            .select("grp", F.col("parent").alias("place"), "n", F.col("children.digest").alias("run"), *([] if runs else [F.col("children.item").alias("items")]))
        )
        nodes = stored(parents.withColumn("digest", _sha256(F.array_join("run", ""))), f"{name}-runs")
        runs.append(nodes)
        tops.append(nodes.filter("n = 1").select("grp", "digest", F.lit(len(runs)).alias("height"), none.alias("item")))
        widest = -(-widest // FANOUT)
    return runs, reduce(DataFrame.unionByName, tops)


def _down(runs: list[DataFrame], known: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Send proofs from the last nodes of the groups down to the lowest ones.

    ``known`` has ``grp, height, item, path`` for the last nodes and the columns that are ``carried`` along. A
    ``path`` lists for each height, from the node up, what stands to its left and to its right.
    Returns ``item, path`` and the carried columns for every lowest node. A run is met by the proof of
    its node and hands it on to its children, so the proofs of the lowest nodes are never shuffled.
    """
    columns = ["grp", F.lit(0).cast("bigint").alias("place"), "item", "path", *carried]
    last = [known.filter(F.col("height") == h).select(*columns) for h in range(len(runs) + 1)]
    proofs = last[len(runs)]
    for height in range(len(runs), 0, -1):
        items = ["items"] if height == 1 else []
        sent = runs[height - 1].select("grp", "place", "run", *items).join(proofs.drop("item"), ["grp", "place"])
        step = F.struct(
            F.array_join(F.slice("run", 1, F.col("i")), "").alias("left"),
            F.array_join(F.slice("run", F.col("i") + 2, FANOUT), "").alias("right"),
        )
        item = F.get("items", F.col("i")) if items else F.lit(None).cast(known.schema["item"].dataType)
        proofs = (
            sent.select("*", F.posexplode("run").alias("i", "own"))
            .select(
                "grp",
                (F.col("place") * FANOUT + F.col("i")).alias("place"),
                item.alias("item"),
                F.concat(F.array(step), "path").alias("path"),
                *carried,
            )
            .unionByName(last[height - 1])
        )
    return proofs.drop("grp", "place")


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    claim: Column | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, leaf, claim, subroot, root, path``.

    Leaves of a group ascend by id; eight consecutive nodes become one until one is left, the
    group's ``subroot``. Subroots, in the order of the groups, become the ``root`` likewise. ``path`` is the
    proof: for each height from the leaf to the root, the digests to the left and to the right.
    ``claim`` is the digest that is to be verified (the leaf itself by default); see ``folded``.

    A null field, a null text too, differs from an empty one. A null group comes first and is a
    group of its own; null ids come before others; rows with one id are ordered by their
    leaves, so the digests do not depend on how rows were dealt. A run of one node is hashed as well,
    but the only leaf of a group is its subroot. An empty table gives an empty result. Other
    columns are not read. Each text is read once, hashed where it lies, and never shuffled.
    """
    leaf = leaf_digest(fields)
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-"))
    leaves = stored(
        docs.select(
            group.alias("grp"),
            F.col(f"`{id_col}`").alias("doc_id"),
            leaf.alias("digest"),
            (leaf if claim is None else F.coalesce(claim, leaf)).alias("claim"),
        ),
        "merkle-leaves",
    )
    order = [F.asc_nulls_first("doc_id"), F.col("digest")]
    lowest = numbered(leaves, "grp", order, "merkle-placed").withColumn("item", F.struct("doc_id", "digest", "claim"))
    runs, subroots = _up(lowest, lowest.agg(F.max("n")).first()[0] or 0, "merkle")
    subroots = stored(subroots.withColumnRenamed("grp", "own"), "merkle-subroots")

    every = F.lit("").alias("grp")
    heads = numbered(subroots.select(every, "own", "digest"), "grp", [F.col("own")], "merkle-heads")
    upper_runs, root = _up(heads.withColumn("item", F.col("own")), heads.count(), "merkle-upper")
    root = root.select("grp", "height", "item", F.col("digest").alias("root"), F.array().cast(_STEPS).alias("path"))
    proven = _down(upper_runs, stored(root, "merkle-root"), ["root"])
    proven = subroots.join(proven.withColumnRenamed("item", "own"), "own")
    proven = proven.select(F.col("own").alias("grp"), "height", "item", "path", "root", F.col("digest").alias("subroot"))
    proofs = _down(runs, stored(proven, "merkle-proven"), ["root", "subroot"])
    return proofs.select("item.doc_id", F.col("item.digest").alias("leaf"), "item.claim", "subroot", "root", "path")


def folded(digest: str = "claim", path: str = "path") -> Column:
    """The root that a digest leads to along a path."""
    return F.aggregate(
        F.col(path), F.col(digest), lambda d, step: F.sha2(F.concat(step["left"], d, step["right"]).cast("binary"), 256)
    )


def proof_text(path: str = "path") -> Column:
    """The siblings of a path as one text, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def lower_case_some(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The claim of a row whose text lost its capitals A-Z where 3 divides the crc32 of the id; else null."""
    changed = leaf_digest(instead={text: lower_ascii(F.col(f"`{text}`"))})
    return F.when(in_fold(doc_id, 3, 0), changed)
