"""Near copies by 64-bit SimHash: Golay-code keys, a join on them, and components.

Two fingerprints link if at most four bits differ. The 64 bits are cut into three segments, each
a word of the binary Golay code [23, 12, 7]. That code is perfect, so between two words that
differ in at most two bits lies one within three bits of some codeword: this codeword is
within four bits of both words, and a word has at most six such codewords. Their 12-bit indices
are the fuzzy keys of a segment. By the pigeonhole principle, four errors in three segments leave

* one segment without an error and another with at most two: the first is a key as it is, with
  the fuzzy keys of the second (33 bits or more); or
* two segments with one error each and at most two in the third: of each of the two, one half is
  free of errors; both halves are a key with the fuzzy keys of the third (32 bits or more).

So linked fingerprints always share a key. Those that do are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import ship_package, stored, whole_bytes, whole_text
from reelmetrics.llm.components import components

# The generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code, 23 bits long;
# the seed of the hash; where the segments begin and how long they are.
GENERATOR, GENERATOR_BITS, CODE_BITS = 0b101011100011, 11, 23
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 4
SHINGLE_WORDS = 4
#: Shingles, and pairs of fingerprints, that are worked on at a time.
BLOCK = 1 << 16
PAIRS = 1 << 22
#: Fingerprints under one key that one task compares.
BUCKET = 20_000


# -- fingerprints ----------------------------------------------------------------------


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: a bit is 1 if over half of the shingles' hashes have it.

    A-Z count as a-z; words end at blanks and at the characters 9 to 13. Shingles are taken with
    repeats. A text with fewer words is one shingle, a text without words has fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = [0, *ends[: n - 1].tolist()], (ends[shingle_words - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], stops[k : k + BLOCK])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 128 * 128
        # Sums of 128 bits fit a byte, which numpy adds much faster.
        ones += bits[:whole].reshape(-1, 128, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a signed 64-bit number; null is the empty text."""

    @F.arrow_udf("bigint")
    def of_batch(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of_batch(whole_bytes(text_col))


# -- Golay keys ------------------------------------------------------------------------


def _remainder(words: np.ndarray) -> np.ndarray:
    """The remainder of 23-bit words modulo the generator, as polynomials over two elements."""
    rest = words.copy()
    for bit in range(CODE_BITS - 1, GENERATOR_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - GENERATOR_BITS), 0)
    return rest


def _error_patterns() -> np.ndarray:
    """By remainder: the patterns of at most four bits that lead from a word to codewords.

    There are one or six of them; a single one is repeated.
    """
    powers = [1 << b for b in range(CODE_BITS)]
    patterns = [0]
    layer = [(0, 0)]
    for _ in range(4):
        layer = [(p | powers[b], b + 1) for p, first in layer for b in range(first, CODE_BITS)]
        patterns += [p for p, _ in layer]
    table: list[list[int]] = [[] for _ in range(1 << GENERATOR_BITS)]
    for pattern, rest in zip(patterns, _remainder(np.array(patterns, np.int64)).tolist()):
        table[rest].append(pattern)
    return np.array([(p * 6)[:6] if len(p) == 1 else p for p in table], np.int64)


def golay_keys(words: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Indices of the codewords within four bits of each 23-bit word, six a row."""
    return (words[:, None] ^ patterns[_remainder(words)]) >> GENERATOR_BITS


def segment_keys(prints: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of distinct fingerprints and the fingerprint of each key."""
    prints = prints.astype(np.uint64)
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    fuzzy = [golay_keys(p, patterns) for p in parts]
    # A word with a single codeword repeats it five times; it needs that key once.
    fresh = [np.concatenate([np.ones((len(prints), 1), bool), f[:, 1:] != f[:, :1]], axis=1) for f in fuzzy]
    families = [(parts[i], j) for i, j in permutations(range(3), 2)]
    for i, j, k in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        halves = [(parts[i] & 0x7FF, parts[i] >> 11), (parts[j] & 0x7FF, parts[j] >> 11)]
        families += [((half_i << 11) | half_j, k) for half_i in halves[0] for half_j in halves[1]]
    keys = [(n << 40) | (exact[:, None] << 12) | fuzzy[j] for n, (exact, j) in enumerate(families)]
    rows, cols = np.nonzero(np.concatenate([fresh[j] for _, j in families], axis=1))
    return np.concatenate(keys, axis=1)[rows, cols], prints[rows]


# -- links -----------------------------------------------------------------------------


def spanning_links(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect those of some distinct fingerprints that chains of near ones connect.

    One link per fingerprint at most, from the first one found of its component. Each step
    compares the newest members of a component with all that have none yet, a bounded number
    of pairs at a time.
    """
    links, rest = [], prints
    while len(rest) > 1:
        root, new, rest = rest[0], rest[:1], rest[1:]
        while len(new) and len(rest):
            step = max(1, PAIRS // len(rest))
            near = (np.bitwise_count(rest[None, :] ^ new[:step, None]) <= max_bits).any(axis=0)
            found, rest = rest[near], rest[~near]
            links += [(int(root), int(x)) for x in found]
            new = np.concatenate([new[step:], found])
    return links


def _linked(held: list[tuple[np.ndarray, ...]], max_bits: int) -> pa.RecordBatch:
    """Links within each run of equal keys."""
    keys, fps = map(np.concatenate, zip(*held))
    cuts = np.flatnonzero(np.diff(keys)) + 1
    starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    several = stops - starts > 1
    found = [x for a, b in zip(starts[several], stops[several]) for x in spanning_links(fps[a:b], max_bits)]
    pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    none = pa.nulls(len(pairs), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none], _LINKED)


_LINKED = ["a", "b", "key", "fp"]


def _bucket_links(keyed: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """Links ``a, b`` within the buckets of sorted rows ``key, fp``, and the rows ``key, fp`` of larger buckets.

    A bucket of more than ``bucket`` fingerprints passes through as it came, so that a task
    never holds more.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last key of a batch may go on in the next one; of a key that is too large nothing is held.
        held: list[tuple[np.ndarray, np.ndarray]] = []
        large: int | None = None

        def passed(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(keys), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.array(keys), pa.array(fps.view(np.int64))], _LINKED)

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            while len(keys):
                end = int(np.searchsorted(keys, keys[0], "right"))
                if large == keys[0]:
                    yield passed(keys[:end], fps[:end])
                    keys, fps = keys[end:], fps[end:]
                    continue
                if held and held[0][0][0] == keys[0]:
                    held.append((keys[:end], fps[:end]))
                    keys, fps = keys[end:], fps[end:]
                    if sum(len(k) for k, _ in held) > bucket:
                        large = int(held[0][0][0])
                        for k, f in held:
                            yield passed(k, f)
                        held = []
                    continue
                if held:
                    yield _linked(held, max_bits)
                    held = []
                # Whole runs that are small enough are linked at once; the last one is held.
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
                sizes = np.diff(cuts)
                for i in np.flatnonzero(sizes[:-1] > bucket):
                    yield passed(keys[cuts[i] : cuts[i + 1]], fps[cuts[i] : cuts[i + 1]])
                small = np.repeat(sizes <= bucket, sizes)
                small[cuts[-2] :] = False
                if small.any():
                    yield _linked([(keys[small], fps[small])], max_bits)
                held = [(keys[cuts[-2] :], fps[cuts[-2] :])]
                keys = keys[:0]
                if len(held[0][0]) > bucket:
                    large = int(held[0][0][0])
                    yield passed(*held[0])
                    held = []
        if held:
            yield _linked(held, max_bits)

    return keyed.mapInArrow(link, "a bigint, b bigint, key bigint, fp bigint")


def _split(large: DataFrame, bucket: int) -> DataFrame:
    """Rows ``key, fp`` of large buckets, dealt to new buckets so that any two fingerprints of a key meet in one.

    The fingerprints of a key are dealt to blocks of about half a bucket by a hash; there is a new bucket
    for each pair of blocks, so the work on one key is spread over many tasks.
    """
    sizes = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 3 / bucket).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks")).cast("int")
    dealt = large.join(sizes, "key").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("key", "fp", "block", other)
    meeting = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return pairs.select(meeting.alias("key"), "fp")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect distinct fingerprints (column ``fp``) exactly as all links would.

    Keys are dealt over the cluster and sorted there; fingerprints with one key are compared
    where they meet. A component is linked as a tree per key, never as all its pairs. Where more than
    ``bucket`` fingerprints have one key, they are dealt again, as pairs of blocks. Stored.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find links of at most {MAX_BITS} bits")
    ship_package(prints.sparkSession)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _error_patterns()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fps), 2000):
                keys, owners = segment_keys(fps[k : k + 2000], patterns)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], ["key", "fp"])

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key", "fp")

    found = stored(_bucket_links(met(prints.select("fp").mapInArrow(keyed, "key bigint, fp bigint")), max_bits, bucket), "near-links")
    links = found.filter("a IS NOT NULL").select("a", "b")
    large = found.filter("a IS NULL").select("key", "fp")
    if not large.isEmpty():
        # A block pair holds more than a bucket only by chance; it is compared whole.
        links = links.union(_bucket_links(met(_split(large, bucket)), max_bits, 1 << 62).select("a", "b"))
    return links.distinct()


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, fp, fingerprint, component_id``.

    ``text_key`` is a 64-bit hash of the text that tells apart rows with one id. ``fingerprint`` is ``fp`` as 16 hexadecimal digits; ``component_id`` is the smallest id that
    links lead to, the document's own included. Equal fingerprints are one node of the graph, so
    copies are never paired. Null and empty texts have fingerprint 0 and link like others. A null
    id is never a component id unless no id in the component is known. Repeated rows give a row
    each. An empty table gives an empty result. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.xxhash64(whole_text(text_col)).alias("text_key"),
            fingerprints(text_col, shingle_words).alias("fp"),
        ),
        "simhash",
    )
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    rooted = components(near_links(nodes, max_bits)).withColumnsRenamed({"node": "fp"})
    rooted = nodes.join(rooted, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    ids = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    named = stored(rooted.join(ids, "root").select("fp", "component_id"), "simhash-names")
    return rows.join(named, "fp").select(
        "doc_id", "text_key", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The documents with one of each component: that with the smallest id. All columns stay.

    Documents are told apart by id and text, null included; rows that repeat both stay or go as
    one, so exact copies should be dropped before.
    """
    found = near_components(docs, id_col, text_col, shingle_words, max_bits)
    gone = stored(
        found.filter("NOT doc_id <=> component_id").select(
            F.col("doc_id").alias("__near_id"), F.col("text_key").alias("__near_key")
        ),
        "near-copies",
    )
    left = docs.withColumn("__key", F.xxhash64(whole_text(text_col)))
    same = left[f"`{id_col}`"].eqNullSafe(gone["__near_id"]) & (left["__key"] == gone["__near_key"])
    return left.join(gone, same, "left_anti").drop("__key")
