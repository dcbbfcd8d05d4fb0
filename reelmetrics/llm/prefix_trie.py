"""The prefix trie of conversations, built as a burst trie.

A conversation is a sequence of turns; a turn counts by role and text, which a 128-bit id stands for,
so texts are hashed where they lie and never shuffled. Every prefix has an id, too: the exclusive
or of a hash of place and turn over its turns. It is formed in chunks, so no conversation must
be held as a whole.

All conversations start in the container of the root. A container of more than ``burst``
conversations bursts by the next turn: its node becomes a trie head and each next turn a container of
its own. Since the size of the container behind every prefix is one count, all bursts are
decided at once: heads are the prefixes of more than ``burst`` conversations, and a conversation
lies in the container of its first prefix that is none. Containers are dealt over the cluster,
sorted by depth, deepest first, and swept into nodes; what a sweep holds at a time is the nodes of one
depth of one container. Heads take sums of what lies below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmetrics.llm.common import ship_package, stored, whole_text
from reelmetrics.llm.ranking import numbered

#: A container of more conversations bursts.
BURST = 256
#: Turns of a conversation whose prefixes one task forms.
CHUNK = 4096
# Conversations start like the first of their hundred, with fewer than six turns of it.
HUNDRED, MOST_GIVEN = 100, 6

NODE = ["depth", "x1", "x2"]


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, n, id1, id2, chars``: the turns, numbered from 0 of n by conversation. Stored.

    Turns are ordered by ``turn``, null first; turns with one number by role, then by a hash of
    role and text. A null role or text is empty. Rows without a conversation take no part.
    """
    role, text = whole_text("role"), whole_text("text")
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.xxhash64(role, text).alias("id1"),
        F.xxhash64(F.lit(1), text, role).alias("id2"),
        F.char_length(text).cast("bigint").alias("chars"),
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("id1"), F.col("id2")]
    return numbered(turns, "conv_id", order, "trie-turns").drop("turn", "role")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of the first one of their hundred.

    Takes the turns of ``turn_ids``. Returns the new turns, ``conv_id, depth`` (from 1)``, id1, id2, chars``,
    and all conversations with their number of turns, ``conv_id, length``. Conversation ``c`` starts with
    the first h turns of ``c - c % 100``, h = crc32(c) % 6, all of them if there are fewer and none if it is
    absent, and goes on with its own turns after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_GIVEN
    lengths = turns.filter("place = 0").select("conv_id", "n")
    firsts = lengths.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    convs = stored(
        lengths.withColumns({"h": h, "first": F.col("conv_id") - F.col("conv_id") % HUNDRED})
        .join(firsts, "first", "left")
        .withColumn("given", F.least("h", F.coalesce("n_first", F.lit(0))))
        .select("conv_id", "first", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
        "trie-convs",
    )
    own = turns.join(convs.select("conv_id", "h", "given"), "conv_id").filter("place >= h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("given") + 1).alias("depth"), "id1", "id2", "chars")
    givers = turns.filter(F.col("place") < MOST_GIVEN).withColumnRenamed("conv_id", "first")
    given = givers.join(convs.select("conv_id", "first", "given"), "first").filter("place < given")
    given = given.select("conv_id", (F.col("place") + 1).alias("depth"), "id1", "id2", "chars")
    return own.unionByName(given), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every prefix of every conversation: ``conv_id, depth, x1, x2, p1, p2, chars, ends``.

    ``x1, x2`` are the id of the prefix, ``p1, p2`` that of its parent; the empty prefix has depth and id
    0. ``ends`` tells whether the conversation ends there.
    """
    hashed = turns.withColumns(
        {
            "h1": F.xxhash64("depth", "id1", "id2"),
            "h2": F.xxhash64("id2", "depth", "id1"),
            "chunk": F.expr(f"(depth - 1) div {CHUNK}"),
        }
    )
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2"))
    before = whole.select(
        "conv_id", "chunk", F.bit_xor("c1").over(earlier).alias("b1"), F.bit_xor("c2").over(earlier).alias("b2")
    )
    within = hashed.withColumns({"r1": F.bit_xor("h1").over(so_far), "r2": F.bit_xor("h2").over(so_far)})
    named = within.join(before, ["conv_id", "chunk"]).withColumns(
        {
            "x1": F.col("r1").bitwiseXOR(F.coalesce("b1", F.lit(0))),
            "x2": F.col("r2").bitwiseXOR(F.coalesce("b2", F.lit(0))),
        }
    )
    below = named.join(convs, "conv_id").select(
        "conv_id",
        "depth",
        "x1",
        "x2",
        F.col("x1").bitwiseXOR(F.col("h1")).alias("p1"),
        F.col("x2").bitwiseXOR(F.col("h2")).alias("p2"),
        "chars",
        (F.col("depth") == F.col("length")).alias("ends"),
    )
    zero = F.lit(0).cast("bigint")
    empty = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), zero.alias("p1"), zero.alias("p2"),
        zero.alias("chars"), (F.col("length") == 0).alias("ends"),
    )
    return stored(below.unionByName(empty), "trie-prefixes")


_SWEPT = "depth bigint, x1 bigint, x2 bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes from the sorted rows of containers: deepest nodes first, the members of a node by id.

    A finished node leaves its sums for its parent, which comes with the next depth.
    """
    out: list[tuple] = []
    container = level = node = None
    due: dict[tuple, list[int]] = {}  # sums for the nodes of this depth, left by their children
    left: dict[tuple, list[int]] = {}  # sums for the nodes of the next one

    def finish() -> None:
        key, members, ended, chars, parent, digest = node
        children, beneath, leaves, saved = due.pop(key[1:], (0, 0, 0, 0))
        alone = members - ended - beneath  # members that are the only one of their child
        leaves = leaves + alone or 1
        saved += (members - 1) * chars
        out.append((*key, children + alone, leaves, saved, digest.hexdigest()))
        sums = left.setdefault(parent, [0, 0, 0, 0])
        for i, more in enumerate((1, members, leaves, saved)):
            sums[i] += more

    def taken() -> pa.RecordBatch:
        names = [field.split()[0] for field in _SWEPT.split(", ")]
        kinds = [pa.string() if n == "ends_sha256" else pa.int64() for n in names]
        batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(list(zip(*out)) or [[]] * len(names), kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        for place, depth, x1, x2, p1, p2, conv, chars, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if node is None or node[0] != (depth, x1, x2) or place != container:
                if node is not None:
                    finish()
                if place != container:
                    container, level, due, left = place, depth, {}, {}
                elif depth != level:
                    level, due, left = depth, left, {}
                node = [(depth, x1, x2), 0, 0, chars, (p1, p2), hashlib.sha256()]
            node[1] += 1
            if ends:
                node[5].update(f",{conv}".encode() if node[2] else str(conv).encode())
                node[2] += 1
        yield taken()
    if node is not None:
        finish()
        yield taken()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the ids of each node, from rows that are sorted by node and id."""
    key, digest, done = None, None, []

    def taken() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])
        done.clear()
        return batch

    for batch in batches:
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if own == key:
                digest.update(f",{conv}".encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(str(conv).encode())
        yield taken()
    if key is not None:
        done.append((*key, digest.hexdigest()))
        yield taken()


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def trie_nodes(turns: DataFrame, convs: DataFrame, burst: int = BURST) -> DataFrame:
    """The nodes of the trie of some conversations, the empty prefix included.

    Takes ``conv_id, depth, id1, id2, chars`` and ``conv_id, length`` as ``rebuilt`` returns them. Returns
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: the smallest member
    names a node; ``saved_tokens`` sums over its subtree, each node's members but one times the characters
    of its last turn; ``ends_sha256`` is of the ids of the members that end there.

    No conversations give no nodes. Equal conversations share all their nodes, however many they
    are; only the digest of the ids that end at one node is formed in one task, as a stream, since
    SHA-256 reads them one after the other. Other columns are not read.
    """
    ship_package(turns.sparkSession)
    paths = prefixes(turns, convs)
    nodes = stored(
        paths.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.max("chars").alias("chars"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
            F.count_if("ends").alias("n_ends"),
        ),
        "trie-nodes",
    )
    heads = nodes.filter(F.col("n_convs") > burst)
    shared = nodes.filter(F.col("n_convs") > 1)

    # A node of one conversation needs no container: below it there is a chain.
    none = _sha256(F.lit(""))
    alone = nodes.filter("n_convs = 1").select(
        *NODE,
        (1 - F.col("n_ends")).alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(F.col("n_ends") == 1, _sha256(F.col("conv_id").cast("string"))).otherwise(none).alias("ends_sha256"),
    )

    # Containers: the first prefix of a conversation that is no head names the one it lies in.
    marked = stored(
        paths.join(shared.select(*NODE, (F.col("n_convs") > burst).alias("head")), NODE), "trie-marked"
    )
    inside = marked.filter("NOT head")
    first = F.min_by(F.struct(*NODE), "depth").alias("container")
    contained = inside.join(inside.groupBy("conv_id").agg(first), "conv_id").select(
        F.xxhash64("container.depth", "container.x1", "container.x2").alias("place"), "container", *NODE, "p1", "p2", "conv_id", "chars", "ends"
    )
    order = ["place", "container", F.desc("depth"), "x1", "x2", "conv_id"]
    swept = stored(
        contained.repartition("place")
        .sortWithinPartitions(*order)
        .select(F.concat_ws(":", "container.depth", "container.x1", "container.x2").alias("place"), *NODE, "p1", "p2", "conv_id", "chars", "ends")
        .mapInArrow(_sweep, _SWEPT),
        "trie-swept",
    )
    upper = _heads(nodes, heads, marked.filter("head"), alone.unionByName(swept), none)
    found = alone.unionByName(swept).unionByName(upper)

    # The parent of a node of a chain is named by the same conversation.
    parents = shared.select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("shared_parent")
    )
    named = nodes.select(*NODE, "p1", "p2", "conv_id", "n_convs").join(parents, ["depth", "p1", "p2"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("shared_parent", "conv_id"))
    return named.join(found, NODE).select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _heads(nodes: DataFrame, heads: DataFrame, members: DataFrame, below: DataFrame, none: Column) -> DataFrame:
    """The trie heads, from the nodes of containers and chains below them.

    What a head adds by itself is booked on its smallest member. Along each such conversation
    these sums run from the deepest head upwards, and a head adds up those of its members.
    """
    parent = [F.col("depth").alias("d"), F.col("p1").alias("x1"), F.col("p2").alias("x2")]
    ends = (
        members.filter("ends").select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(_ends, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    )
    is_head = heads.select(*NODE, F.lit(1).alias("head"))
    children = (
        nodes.select(*NODE, "p1", "p2")
        .join(below.select(*NODE, "n_leaves", "saved_tokens"), NODE, "left")
        .filter("depth > 0")
        .groupBy(*parent)
        .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        .withColumn("depth", F.col("d") - 1)
        .drop("d")
        .join(is_head.drop("head"), NODE, "left_semi")
    )
    zero = F.lit(0).cast("bigint")
    own = stored(
        heads.join(children, NODE, "left").select(
            *NODE,
            "conv_id",
            F.coalesce("n_children", zero).alias("n_children"),
            F.when(F.coalesce("n_children", zero) == 0, 1).otherwise(F.coalesce("leaves", zero)).alias("leaves"),
            (F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "trie-heads",
    )
    booked = own.select("conv_id", "depth", "leaves", "saved")
    upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        members.select(*NODE, "conv_id")
        .join(booked.select("conv_id").distinct(), "conv_id", "left_semi")
        .join(booked, ["conv_id", "depth"], "left")
        .select(*NODE, F.sum("leaves").over(upwards).alias("leaves"), F.sum("saved").over(upwards).alias("saved"))
        .groupBy(*NODE)
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    return (
        own.select(*NODE, "n_children")
        .join(sums, NODE)
        .join(ends, NODE, "left")
        .select(*NODE, "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
    )


def conversation_trie(conversations: DataFrame, burst: int = BURST) -> DataFrame:
    """The trie of the rebuilt conversations of a table ``conv_id, turn, role, text``; see ``trie_nodes``.

    Null turns come first and null roles and texts are empty; rows without a conversation are left
    out. Repeated rows are turns of their own. An empty table gives no nodes. A conversation that is
    left without turns is a member of the root alone.
    """
    return trie_nodes(*rebuilt(turn_ids(conversations)), burst)
