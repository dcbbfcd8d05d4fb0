"""Benchmark decontamination: a prefix-filtered join of benchmark windows with documents.

A window is a set of positioned shingles. Shingles are ordered by how often they occur in the
documents, the rarest first. A document holds a whole window only if it holds the window's
rarest shingle (its prefix, as all shingles must be there), at a place that leaves room for the
words before and after it; then the words are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmetrics.llm.common import NOT_WORD, WORD_BYTES, lower_ascii, ship_package, stored, whole_bytes, whole_text

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Windows that are looked for in one pass over the documents; about 300 bytes each.
BLOCK_WINDOWS = 200_000


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, words``: the windows of each item; a shorter item is one window, one without words none."""
    text = F.regexp_replace(lower_ascii(whole_text(text_col)), NOT_WORD, " ")
    words = F.filter(F.split(text, " "), lambda w: w != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return (
        items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), words.alias("words"))
        .filter(F.size("words") > 0)
        .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, window))).alias("words"))
        .distinct()
    )


class Shingles:
    """Numbers for the words of a block of windows, and codes for their shingles.

    A code is the numbers of the shingle's words as digits; a word outside the block has
    number 0. Shingles of short windows are the whole window.
    """

    def __init__(self, windows: list[list[str]], size: int):
        self.numbers = {w.encode(): i for i, w in enumerate(sorted({w for words in windows for w in words}), 1)}
        self.base, self.size = len(self.numbers) + 1, size
        if self.base**size >= 1 << 63:
            raise ValueError("too many words for one block of windows")

    def ids(self, text: bytes) -> np.ndarray:
        number = self.numbers.get
        words = text.translate(WORD_BYTES).split()
        return np.array([number(w, 0) for w in words], np.int64)

    def codes(self, ids: np.ndarray, size: int) -> np.ndarray:
        """The code of the shingle that begins at each place; 0 where it has a word from outside."""
        n = len(ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        code, inside = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(size):
            part = ids[k : k + n]
            code = code * self.base + part
            inside &= part > 0
        return np.where(inside, code, 0)


class Index:
    """The windows of a block by their rarest shingle."""

    def __init__(self, shingles: Shingles, rows: list[tuple[int, str, list[str]]], at: dict[int, int]):
        """``rows``: number, item and words of each window; ``at``: where its rarest shingle begins."""
        self.shingles, self.items = shingles, [item for _, item, _ in rows]
        # By shingle size: sorted codes of prefixes, and for each code its windows with offset.
        self.by_size: dict[int, tuple[np.ndarray, list[list[tuple[int, int, np.ndarray]]]]] = {}
        found: dict[int, dict[int, list]] = {}
        for n, (number, _, words) in enumerate(rows):
            ids = shingles.ids(" ".join(words).encode())
            size, offset = min(shingles.size, len(ids)), at[number]
            code = int(shingles.codes(ids[offset : offset + size], size)[0])
            found.setdefault(size, {}).setdefault(code, []).append((n, offset, ids))
        for size, entries in found.items():
            codes = sorted(entries)
            self.by_size[size] = (np.array(codes, np.int64), [entries[c] for c in codes])

    def search(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, the places that lie in a window, and the items whose windows occur."""
        ids = self.shingles.ids(text)
        hit, items = np.zeros(len(ids), bool), set()
        for size, (known, entries) in self.by_size.items():
            codes = self.shingles.codes(ids, size)
            places = np.flatnonzero(codes)
            if not len(places):
                continue
            at = np.minimum(np.searchsorted(known, codes[places]), len(known) - 1)
            same = known[at] == codes[places]
            for place, entry in zip(places[same].tolist(), at[same].tolist()):
                for n, offset, words in entries[entry]:
                    start = place - offset
                    stop = start + len(words)
                    # The place must leave room for the whole window; then every word counts.
                    if start >= 0 and stop <= len(ids) and np.array_equal(ids[start:stop], words):
                        hit[start:stop] = True
                        items.add(self.items[n])
        return len(ids), np.flatnonzero(hit), items


def _shingle_counts(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """``code, n``: how often the shingles of a block of windows occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, wanted = shared.value
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for text in batch.column(0):
                ids = shingles.ids(text.as_py())
                codes = shingles.codes(ids, shingles.size)
                codes = codes[codes > 0]
                at = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
                found.append(codes[wanted[at] == codes])
            codes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["code", "n"])

    return texts.mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def _block_index(texts: DataFrame, rows: list[tuple[int, str, list[str]]], shingle_words: int) -> Index:
    """Count the shingles of a block of windows over all documents and index each window by its rarest."""
    spark = texts.sparkSession
    shingles = Shingles([words for _, _, words in rows], shingle_words)
    placed = []
    for number, _, words in rows:
        codes = shingles.codes(shingles.ids(" ".join(words).encode()), shingle_words)
        placed += [(number, k, int(c)) for k, c in enumerate(codes)]
    wanted = np.unique(np.array([c for _, _, c in placed], np.int64))
    at = {number: 0 for number, _, _ in rows}
    if len(wanted):
        shared = spark.sparkContext.broadcast((shingles, wanted))
        counts = _shingle_counts(texts, shared)
        # Both tables have at most one row per shingle of the block. As an Arrow table it needs no Python workers of another kind.
        numbers, places, codes = zip(*placed)
        table = pa.table({"number": pa.array(numbers, pa.int64()), "at": pa.array(places, pa.int32()), "code": pa.array(codes, pa.int64())})
        entries = spark.createDataFrame(table).join(counts, "code", "left")
        rarest = Window.partitionBy("number").orderBy(F.coalesce("n", F.lit(0)), "at")
        first = entries.withColumn("place", F.row_number().over(rarest)).filter("place = 1")
        at |= {r["number"]: r["at"] for r in first.select("number", "at").collect()}
    return Index(shingles, rows, at)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The documents with a column ``contamination``: struct of ``n_words, n_hit, n_items, items, contaminated``.

    A word is hit if it lies in any occurrence of a window of any item; ``items`` are the ids of
    these items as text, sorted and comma-joined. A large benchmark is worked off in blocks
    of ``block_windows`` windows, one pass over the documents each, and a row carries the hits of all
    blocks along. All columns of the documents stay; one of the name ``contamination`` is replaced.

    Null and empty texts have no words; items without words have no windows. Rows that repeat
    an id are searched each on their own; items that repeat an id count once; a null item id is
    left out of ``items``, but its windows count. Empty tables are allowed on either side.
    """
    ship_package(docs.sparkSession)
    windows = stored(
        item_windows(items, item_col, item_text_col, window).withColumn("number", F.monotonically_increasing_id()), "windows"
    )
    parts = max(1, -(-windows.count() // block_windows))
    texts = docs.select(whole_bytes(text_col).alias("text"))
    searches = []
    for part in range(parts):
        chosen = windows.filter(F.pmod(F.xxhash64("number"), F.lit(parts)) == part)
        rows = [(r["number"], r["item_id"], r["words"]) for r in chosen.collect()]
        searches.append(_search(docs.sparkSession.sparkContext.broadcast(_block_index(texts, rows, shingle_words))))
    if parts == 1:
        return docs.withColumn("contamination", _summed(searches[0](whole_bytes(text_col))))

    # What a pass finds depends on the text alone and is kept by its digest, found texts only.
    key = F.unhex(F.sha2(whole_bytes(text_col), 256))
    passes = [
        stored(
            docs.select(key.alias("key"), search(whole_bytes(text_col)).alias("found"))
            .filter(F.size("found.places") > 0).groupBy("key").agg(F.any_value("found").alias("found")),
            "contaminated",
        )
        for search in searches
    ]
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    # At most one row per text and block.
    merged = every.groupBy("key").agg(
        F.struct(
            F.any_value("found.n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("found.places"))).alias("places"),
            F.array_distinct(F.flatten(F.collect_list("found.items"))).alias("items"),
        ).alias("__found")
    )
    text = F.regexp_replace(lower_ascii(whole_text(text_col)), NOT_WORD, " ")
    n_words = F.size(F.filter(F.split(text, " "), lambda w: w != "")).cast("bigint")
    nothing = F.struct(n_words.alias("n_words"), F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("items"))
    joined = docs.withColumn("__key", key).join(stored(merged.withColumnRenamed("key", "__key"), "contaminated"), "__key", "left")
    return joined.withColumn("contamination", _summed(F.coalesce("__found", nothing))).drop("__key", "__found")


def _search(index: Broadcast):
    """A function of a text column: number of words, places that are hit, and items found."""

    @F.arrow_udf("struct<n_words: bigint, places: array<int>, items: array<string>>")
    def search(batch: pa.Array) -> pa.Array:
        n_words, places, items = [], [], []
        for text in batch:
            n, hit, found = index.value.search(text.as_py())
            n_words.append(n)
            places.append(hit)
            items.append(sorted(found - {None}))
        columns = [pa.array(n_words, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, ["n_words", "places", "items"])

    return search


def _summed(found: Column) -> Column:
    return F.transform(
        F.array(found),
        lambda x: F.struct(
            x["n_words"].alias("n_words"),
            F.size(x["places"]).cast("bigint").alias("n_hit"),
            F.size(x["items"]).cast("bigint").alias("n_items"),
            F.concat_ws(",", F.array_sort(x["items"])).alias("items"),
            (F.size(x["places"]) > 0).alias("contaminated"),
        ),
    )[0]


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a word in any occurrence of a window; all columns stay.

    A column ``contamination`` of the documents is kept as it is.
    """
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{options.pop('text_col', 'text')}`").alias("text"))
    marked = contamination(inner, items, text_col="text", **options)
    return marked.filter("NOT contamination.contaminated").select("row.*")
