"""Documents whose sets of word n-grams are similar, found by filters under several global orders.

For a Jaccard similarity of ``percent`` or more, the sets of two documents must share a token among
their first few under *any* order of all tokens, and more of them in longer prefixes. Three orders are
used: by rarity, and by two hashes. Pairs that meet in the prefix by rarity are candidates; they must
fit in length and position and share enough tokens in each of the two hash prefixes as well, which
texts with a common passage do not. Before that, sketches of 256 bits tell most pairs apart: each bit is the parity
of the tokens that fall to it, so two sketches differ in no more bits than the sets have tokens apart. Only what passes
all filters is compared token by token.

Rarity is the number of different texts that have a token. All tokens are counted; what is broadcast is a
table of a fixed width with the counts of the most frequent ones, as many as it has room for. Others are
ordered by their hash: any order gives the same links, a good one fewer candidates.

Many documents may share a prefix token, so the pairs of a bucket are never listed as they are.
Each round takes a few leaders per bucket, out of the largest component that it holds by then, and compares
the other members with them; members that are connected need no comparison any more. When few pairs of different components are
left, when rounds have become slow and not too many pairs are left, or when a round has found no new link, all pairs that are left
are compared. So every link between components is found, and a group of near copies costs a few comparisons for each of its members. Members
bring their sketches along, so a pair that its sketches tell apart is never a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import ship_package, stored, whole_bytes, whole_text
from reelmetrics.llm.components import components
from reelmetrics.llm.packed import joined, packed, top, unpacked
from reelmetrics.llm.wordhash import blocks, hash_places, mixed, words_of_texts

SHINGLE_WORDS, PERCENT = 3, 90
#: Counters of the table of token counts, a byte each, how many are sent at a time, and the most tokens that are entered.
WIDTH, SLICE, MOST_COUNTED = 1 << 25, 1 << 18, 1 << 24
#: Tokens that a task holds before it sends them, the bits that number their buckets, and those below that it sends.
HELD, BUCKET_BITS, SENT_BITS = 1 << 20, 10, 32
#: 64-bit words of a sketch.
SKETCH = 4
#: A list of candidate documents up to this length (16 bytes each) is broadcast, and up to a quarter as many pairs of them.
BROADCAST_KEYS = 1_000_000
#: Bytes of texts that are hashed at a time.
BLOCK = 1 << 20
#: Members of a bucket that lead in a round, and rounds at most.
LEADERS, ROUNDS = 8, 8
#: A round is slow that finds fewer links than the best one by this factor. Then so many pairs left for each member of a
#: bucket, or so many in all, are few enough to compare them at once, which takes seconds.
SLOW, FEW, FEW_PAIRS = 16, 16, 1 << 24

KEY = ["k1", "k2"]

# -- tokens ----------------------------------------------------------------------------


def shingle_sets(texts: Iterable[bytes], shingle_words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct word n-grams as ascending 64-bit hashes.

    A text with fewer words is one n-gram, a text without words has none.
    """
    for run in blocks(texts, BLOCK):
        data, starts, lengths, bounds = words_of_texts(run)
        words = hash_places(data, starts, lengths)
        grams = _joined(words, shingle_words)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = b - a
            found = grams[a : b - shingle_words + 1] if n >= shingle_words else _joined(words[a:b], n) if n else words[:0]
            yield np.unique(found)


def _joined(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` words in a row."""
    total = np.full(max(0, len(words) - n + 1), np.uint64(n))
    with np.errstate(over="ignore"):
        for k in range(n):
            total = mixed(total + words[k : len(words) - n + 1 + k]) if len(total) else total
    return total


def shingle_set(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    return next(shingle_sets([text], shingle_words))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """How many first tokens of a set of ``n``, under any order, a similar set must meet."""
    return n - -(-percent * n // 100) + 1 if n else 0


def shared_prefix(n: int, percent: int = PERCENT) -> int:
    """How many first tokens of a set of ``n`` must hold ``prefix_size(n)`` common ones with a similar set of that size or more.

    Each token by which a prefix is longer than ``prefix_size`` is one more that must be shared.
    """
    return max(0, 2 * prefix_size(n, percent) - 1)


def _second(tokens: np.ndarray) -> np.ndarray:
    """The value that the second hash order sorts by."""
    return mixed(tokens ^ np.uint64(0x9E3779B97F4A7C15))


# -- counts ----------------------------------------------------------------------------


def _counters(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(32)).astype(np.int64) & (WIDTH - 1)


def _fresh(keys: pa.Array, more: pa.Array, seen: set) -> list[int]:
    """The places of texts that a task has not seen."""
    places = []
    for i, key in enumerate(zip(keys.to_pylist(), more.to_pylist())):
        if key not in seen:
            seen.add(key)
            places.append(i)
    return places


def _all_tokens(shingle_words: int):
    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(held))
        held.clear()
        below = top(tokens, BUCKET_BITS + SENT_BITS).astype(np.uint32)
        return pa.RecordBatch.from_arrays(packed(top(tokens, BUCKET_BITS), [below]), ["bucket", "tokens"])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tokens of each different text of a task, by buckets: their first bits."""
        seen, held = set(), []
        for batch in batches:
            for at in range(0, len(batch), 2000):
                k1, k2, texts = batch.slice(at, 2000).columns
                for found in shingle_sets((texts[i].as_py() for i in _fresh(k1, k2, seen)), shingle_words):
                    held.append(found)
                if sum(map(len, held)) > HELD:
                    yield sent(held)
        if held:
            yield sent(held)

    return tokens


def _shared_tokens(bucket: pa.Table) -> pa.Table:
    """Of all tokens of a bucket, those that come twice or more, with eight times the logarithm of how often.

    Tokens are known by their first ``BUCKET_BITS + SENT_BITS`` bits here; the others are 0.
    """
    below, n = np.unique(joined(unpacked(bucket.column("tokens"), np.uint32), np.uint32), return_counts=True)
    below, n = below[n > 1].astype(np.uint64), n[n > 1]
    first = np.uint64(bucket.column("bucket")[0].as_py()) << np.uint64(SENT_BITS)
    tokens = (first | below) << np.uint64(64 - BUCKET_BITS - SENT_BITS)
    levels = np.minimum(np.floor(np.log2(n) * 8), 255).astype(np.int32)
    return pa.table({"token": tokens.view(np.int64), "level": levels})


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the table from rows ``slot, level``, compressed."""
    slices: dict[int, np.ndarray] = {}
    for batch in batches:
        slots, levels = (c.to_numpy() for c in batch.columns)
        for k in np.unique(slots // SLICE).tolist():
            part = slices.setdefault(k, np.zeros(SLICE, np.uint8))
            own = slots // SLICE == k
            np.maximum.at(part, slots[own] % SLICE, levels[own].astype(np.uint8))
    for k, part in slices.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part, 1)], pa.binary())], ["slice", "levels"])


def rarity_table(texts: DataFrame, shingle_words: int = SHINGLE_WORDS, most: int = MOST_COUNTED) -> np.ndarray:
    """Of ``k1, k2, text``, how frequent tokens are: ``WIDTH`` numbers, which grow with the logarithm of the texts that have a token.

    Tokens of one text have 0. So have the rarer ones of the others, if there are more than ``most``:
    where to cut is told by the number of tokens of each level. Tokens are told apart by 42 bits, those that place
    them in the table included; two that are taken for one are only thought to be more frequent.
    """
    tokens = texts.mapInArrow(_all_tokens(shingle_words), "bucket bigint, tokens binary")
    counts = stored(tokens.groupBy("bucket").applyInArrow(_shared_tokens, "token bigint, level int"), "similar-counts")
    left, cut = most, 256
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        cut = r["level"]
    slot = F.shiftrightunsigned("token", 32).bitwiseAND(F.lit(WIDTH - 1)).cast("int")
    entered = counts.filter(F.col("level") >= cut).select(slot.alias("slot"), "level")
    packed = entered.repartition(F.shiftright("slot", SLICE.bit_length() - 1)).mapInArrow(_packed, "slice int, levels binary")
    table = np.zeros(WIDTH, np.uint8)
    # At most the compressed table reaches the driver. One job fetches all slices; an iterator starts one for each partition.
    for r in packed.collect():
        table[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(zlib.decompress(r["levels"]), np.uint8)
    return table


# -- prefixes --------------------------------------------------------------------------


def _rare_prefixes(table, shingle_words: int, percent: int):
    names = ["token", *KEY, "n", "at"]

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest tokens of each text, and a row at -1 with the number of all; once for the copies that a task has."""
        counts, seen = table.value, set()
        for batch in batches:
            for start in range(0, len(batch), 1000):
                k1, k2, texts = batch.slice(start, 1000).columns
                places = _fresh(k1, k2, seen)
                first, at, sizes = [], [], []
                for tokens in shingle_sets((texts[i].as_py() for i in places), shingle_words):
                    p = prefix_size(len(tokens), percent)
                    rare = np.argsort(counts[_counters(tokens)], kind="stable")[:p]
                    first += [np.zeros(1, np.uint64), tokens[rare]]
                    at.append(np.arange(-1, p))
                    sizes.append((p + 1, len(tokens)))
                repeats, n = np.array(sizes, np.int64).reshape(-1, 2).T
                keys = [np.repeat(k.to_numpy()[places], repeats) for k in (k1, k2)]
                token = np.concatenate(first).view(np.int64) if first else np.zeros(0, np.int64)
                columns = [token, *keys, np.repeat(n, repeats), np.concatenate(at) if at else np.zeros(0, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return prefixes


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The parities of the tokens that fall to each of some bits.

    A token that only one of two sets has turns one bit, so sketches differ in that many bits at most.
    """
    parity = np.bincount((tokens & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _sets(shingle_words: int, percent: int):
    names = [*KEY, "tokens", "a", "b", "sketch"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole sets, their prefixes under the two hash orders, long enough to hold many common tokens, and sketches."""
        for batch in batches:
            for at in range(0, len(batch), 200):
                k1, k2, texts = batch.slice(at, 200).columns
                found = list(shingle_sets((t.as_py() for t in texts), shingle_words))
                first = [t[: shared_prefix(len(t), percent)] for t in found]
                second = [np.sort(_second(t))[: shared_prefix(len(t), percent)] for t in found]
                lists = [pa.array([t.view(np.int64) for t in part], pa.list_(pa.int64())) for part in (found, first, second, map(sketch, found))]
                yield pa.RecordBatch.from_arrays([k1, k2, *lists], names)

    return sets


# -- candidates ------------------------------------------------------------------------


def _apart(percent: int) -> Column:
    """Whether the sketches of ``x`` and ``y`` differ in no more bits than similar sets have tokens apart."""
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in _SKETCH])
    return bits * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)


def _fits(percent: int) -> Column:
    """Length, position and sketches: whether two members of a bucket, ``x`` and ``y``, may be similar.

    Similar sets share enough tokens from their first common one on; other common tokens need not
    bring a pair forward.
    """
    n, m = F.col("x.n"), F.col("y.n")
    behind = F.least(n - F.col("x.at"), m - F.col("y.at"))
    lengths = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return lengths & (behind * (100 + percent) >= (n + m) * percent) & _apart(percent)


_PAIR = ["x1", "x2", "y1", "y2"]
_SKETCH = [f"s{k}" for k in range(SKETCH)]
#: What a member of a bucket has besides its token.
_MEMBER = [*KEY, "n", "at", *_SKETCH, "c1", "c2"]


def _pairs(joined: DataFrame) -> DataFrame:
    """Distinct pairs of documents, the smaller key first."""
    x, y = F.struct("x.k1", "x.k2"), F.struct("y.k1", "y.k2")
    less, more = F.least(x, y), F.greatest(x, y)
    return joined.select(
        less["k1"].alias("x1"), less["k2"].alias("x2"), more["k1"].alias("y1"), more["k2"].alias("y2")
    ).distinct()


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of some stored pairs that share enough tokens under both hash orders and are similar indeed.

    The prefixes of both hash orders have 2 p - 1 tokens for the p that must meet; so similar
    sets share the smaller p of theirs, under each order.
    """
    own = {side: [F.col("k1").alias(f"{side}1"), F.col("k2").alias(f"{side}2")] for side in "xy"}
    # Only the sets of these pairs move on.
    keys = pairs.select(F.explode(F.array(F.struct(F.col("x1").alias("k1"), F.col("x2").alias("k2")), F.struct(F.col("y1").alias("k1"), F.col("y2").alias("k2")))).alias("k"))
    keys = keys.select("k.*").distinct()
    n = pairs.count()
    sets = sets.join(F.broadcast(keys) if 2 * n <= BROADCAST_KEYS else keys, KEY, "left_semi")
    pairs = F.broadcast(pairs) if 4 * n <= BROADCAST_KEYS else pairs
    hashed = {side: sets.select(*own[side], F.col("a").alias(f"a{side}"), F.col("b").alias(f"b{side}")) for side in "xy"}
    whole = {side: sets.select(*own[side], F.col("tokens").alias(f"t{side}")) for side in "xy"}

    def meet(order: str) -> Column:
        x, y = f"{order}x", f"{order}y"
        return F.size(F.array_intersect(x, y)) * 2 > F.least(F.size(x), F.size(y))

    left = (
        pairs.join(hashed["x"], ["x1", "x2"]).join(hashed["y"], ["y1", "y2"]).filter(meet("a") & meet("b")).select(*_PAIR)
    )
    compared = left.join(whole["x"], ["x1", "x2"]).join(whole["y"], ["y1", "y2"])
    shared = F.size(F.array_intersect("tx", "ty"))
    return compared.filter(shared * (100 + percent) >= (F.size("tx") + F.size("ty")) * percent).select(*_PAIR)


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between labels, ``x, y``, of links between keys."""
    of = {side: labels.select(F.col("k1").alias(f"{side}1"), F.col("k2").alias(f"{side}2"), F.struct("c1", "c2").alias(side)) for side in "xy"}
    return links.join(of["x"], ["x1", "x2"]).join(of["y"], ["y1", "y2"]).filter("x != y").select("x", "y").distinct()


def _relabelled(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels ``k1, k2, c1, c2`` of keys after some labels, ``old``, became others, ``new``."""
    moved = labels.select("k1", "k2", F.struct("c1", "c2").alias("old")).join(merged, "old", "left")
    return stored(moved.select("k1", "k2", F.coalesce("new", "old").alias("c")).select("k1", "k2", "c.*"), "similar-labels")


def _merged(labels: DataFrame, between: DataFrame) -> DataFrame:
    """Labels after links between them: of two that are linked the larger becomes the smaller.

    What is merged is connected. Not all that is connected has one label afterwards.
    """
    hooked = stored(between.groupBy(F.greatest("x", "y").alias("old")).agg(F.min(F.least("x", "y")).alias("new")), "similar-hooked")
    # Two steps along the chains of hooks.
    steps = hooked
    for _ in range(2):
        ahead = hooked.select(F.col("old").alias("new"), F.col("new").alias("next"))
        steps = steps.join(ahead, "new", "left").select("old", F.coalesce("next", "new").alias("new"))
    return _relabelled(labels, steps)


def _connected(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels so that exactly the keys that links connect have one."""
    between = stored(_between(links, labels), "similar-between")
    if between.isEmpty():
        return labels
    roots = components(between.select(F.col("x").alias("a"), F.col("y").alias("b")))
    return _relabelled(labels, roots.select(F.col("node").alias("old"), F.col("root").alias("new")))


def _mixed(mates: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold two labels or more, each with its label."""
    found = mates.drop("c1", "c2").join(labels, KEY)
    apart = found.groupBy("token").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("c1", "c2")])
    apart = apart.filter("min_c1 != max_c1 OR min_c2 != max_c2").select("token")
    return stored(found.join(apart, "token", "left_semi"), "similar-members")


def _label_sizes(members: DataFrame, turn: int, leaders: int) -> DataFrame:
    """Per bucket the pairs of members with different labels, and leaders out of the label that most members have.

    A leader has the smallest hash of its key in one of ``leaders`` orders, each turn in others. So one document
    leads in most buckets that it shares with others, and a bucket sends one row per task and label.
    """
    fields = F.struct(*_MEMBER)
    chosen = F.array(*[F.min_by(fields, F.xxhash64(F.lit(turn), F.lit(k), "k1", "k2")) for k in range(leaders)])
    size = members.groupBy("token", "c1", "c2").agg(F.count(F.lit(1)).alias("s"), chosen.alias("led"))
    total, squares = F.sum(F.col("s").cast("double")), F.sum(F.col("s").cast("double") * F.col("s"))
    return stored(
        size.groupBy("token").agg(((total * total - squares) / 2).alias("open"), F.array_distinct(F.max_by("led", F.struct("s", "c1", "c2"))).alias("led")),
        "similar-buckets",
    )


def _different() -> Column:
    return (F.col("x.c1") != F.col("y.c1")) | (F.col("x.c2") != F.col("y.c2"))


def _led_pairs(members: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members with the leaders of their bucket that have another label."""
    fields = F.struct(*_MEMBER)
    led = buckets.select("token", F.explode("led").alias("x"))
    return _pairs(members.select("token", fields.alias("y")).join(led, "token").filter(_different() & _fits(percent)))


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of one bucket that have different labels."""
    fields = F.struct(*_MEMBER)
    one, other = members.select("token", fields.alias("x")), members.select("token", fields.alias("y"))
    ordered = (F.col("x.k1") < F.col("y.k1")) | ((F.col("x.k1") == F.col("y.k1")) & (F.col("x.k2") < F.col("y.k2")))
    return _pairs(one.join(other, "token").filter(ordered & _different() & _fits(percent)))


def similar_links(mates: DataFrame, sets: DataFrame, percent: int = PERCENT, leaders: int = LEADERS, rounds: int = ROUNDS) -> DataFrame:
    """``k1, k2, c1, c2``: for each key of ``mates`` the component, which links between similar sets make.

    ``mates`` are the members of buckets, ``token, k1, k2, n, at``; ``sets`` has the keys with their tokens,
    hash prefixes and sketches. The number of rounds bounds only the rounds with leaders: what is left
    after them is compared pair by pair.
    """
    size, found, last, turn = mates.count(), [], False, 0
    n, most, slow = 0, 0, False
    labels = mates.select(*KEY).distinct().select(*KEY, F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    sketches = sets.select(*KEY, *[F.col("sketch")[k].alias(s) for k, s in enumerate(_SKETCH)])
    own = {"c1": F.col("k1"), "c2": F.col("k2")}
    members = stored(mates.join(sketches, KEY).withColumns(own).select("token", *_MEMBER), "similar-members")
    while not last:
        # Buckets of one label stay so, and need no look any more. Without new links they are as before.
        members = _mixed(members, labels) if found and n else members
        buckets = _label_sizes(members, turn, 1 if turn == 0 else leaders)
        left = buckets.agg(F.sum("open")).first()[0] or 0
        if not left:
            break
        last = left <= 2 * size or turn >= rounds or (slow and left <= max(FEW * size, FEW_PAIRS))
        pairs = _all_pairs(members, percent) if last else _led_pairs(members, buckets, percent)
        pairs = stored(pairs, "similar-near")
        links = stored(_links(pairs, sets, percent), "similar-links")
        n = links.count()
        if not n:
            turn = rounds  # leaders find nothing more
            continue
        most = max(most, n)
        slow = n * SLOW < most
        found.append(links)
        labels = _merged(labels, _between(links, labels))
        turn += 1
    return _connected(labels, reduce(DataFrame.unionByName, found)) if found else labels


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents link if the sets of their word n-grams have a Jaccard similarity of ``percent`` or more;
    A-Z count as a-z, words end at blanks and at the characters 9 to 13. A text with fewer words is
    one n-gram; null texts and texts without words have none and link with nothing, not even
    each other. ``component_id`` is the smallest id that links lead to, the document's own included; a
    null id counts only if no other id is known. Equal texts are compared as one. Repeated rows give
    a row each. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = whole_text(text_col)
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
    texts = docs.select(*keys, whole_bytes(text_col).alias("text"))
    table = spark.sparkContext.broadcast(rarity_table(texts, shingle_words))
    prefixes = stored(
        texts.mapInArrow(
            _rare_prefixes(table, shingle_words, percent), "token bigint, k1 bigint, k2 bigint, n bigint, at bigint"
        ),
        "similar-prefixes",
    )
    table.destroy()
    tokens = prefixes.filter("at >= 0")
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("token")
    mates = stored(tokens.join(met, "token", "left_semi").distinct(), "similar-met")
    apart = mates.groupBy("token").count().filter("count > 1").select("token")
    mates = stored(mates.join(apart, "token", "left_semi"), "similar-mates")

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *keys)
    sizes = prefixes.filter("at < 0").groupBy(*KEY).agg(F.max("n").alias("n"))
    least = stored(rows.groupBy(*KEY).agg(F.min("doc_id").alias("least")).join(sizes, KEY), "similar-keys")
    # Of equal texts, that with the smallest id gives the set.
    wanted = stored(mates.select(*KEY).distinct().join(least.drop("n"), KEY).withColumnsRenamed({"k1": "w1", "k2": "w2"}), "similar-wanted")
    n_wanted = wanted.count()
    wanted = F.broadcast(wanted) if n_wanted <= BROADCAST_KEYS else wanted
    named = docs.select(F.col(f"`{id_col}`").alias("id"), *keys, whole_bytes(text_col).alias("text"))
    own = (named["k1"] == wanted["w1"]) & (named["k2"] == wanted["w2"]) & named["id"].eqNullSafe(wanted["least"])
    sets = named.join(wanted, own, "left_semi").select(*KEY, "text")
    sets = stored(sets.mapInArrow(_sets(shingle_words, percent), "k1 bigint, k2 bigint, tokens array<bigint>, a array<bigint>, b array<bigint>, sketch array<bigint>"), "similar-sets")
    if sets.count() > n_wanted:  # rows that repeat id and text
        sets = stored(sets.dropDuplicates(KEY), "similar-sets")
    linked = similar_links(mates, sets, percent)

    label = {"c1": F.coalesce("c1", "k1"), "c2": F.coalesce("c2", "k2")}
    held = stored(least.join(linked, KEY, "left").withColumns(label), "similar-held")
    firsts = held.groupBy("c1", "c2").agg(F.min("least").alias("component_id"))
    labelled = held.join(firsts, ["c1", "c2"]).select(*KEY, "n", "component_id")
    return rows.join(labelled, KEY).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
