"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: counts of every byte after the bytes before it, from
``order`` of them down to none. A byte that a context has not seen costs an escape and is coded by the
next shorter context; the last resort is one of 256 equal bytes. The statistics are frozen after
training, so the exact code length of a byte depends on the bytes before it alone. The trees of all
languages are kept as sorted tables: a row for each context and byte that some language has seen,
with the code length under every language, and a row for each context, with its escapes.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import in_fold, not_in_fold, ship_package, whole_bytes, whole_text
from reelmetrics.llm.index import Index

#: Bytes of context: of ``learn`` by itself, and of language identification.
ORDER, DEEP_ORDER = 2, 4
#: Code lengths that a model may hold, 4 bytes each; with very many languages the order shrinks to fit.
MAX_CELLS = 1 << 26
#: Bytes of text that are looked up at a time.
BLOCK = 1 << 18
UNKNOWN = "und"
#: A byte without any language.
MOST_BITS = 8.0


@dataclass
class Level:
    """Contexts of one length: code lengths by context and byte, and escapes by context, by language."""

    symbols: Index
    bits: np.ndarray
    contexts: Index
    escapes: np.ndarray


@dataclass
class Model:
    """``single`` has the code length of each byte without a context; ``levels`` the contexts of one byte and more."""

    languages: list[str]
    single: np.ndarray
    levels: list[Level]

    def lengths(self, text: bytes) -> np.ndarray:
        """The code length of a text in bits under each language."""
        total, order = np.zeros(len(self.languages)), len(self.levels)
        for k in range(0, len(text), BLOCK):
            # A text begins as if blanks stood before it.
            before = b" " * max(0, order - k) + text[max(0, k - order) : k]
            total += self._block(np.frombuffer(before + text[k : k + BLOCK], np.uint8))
        return total

    def _block(self, data: np.ndarray) -> np.ndarray:
        order, total = len(self.levels), np.zeros(len(self.languages))
        grams = _packed(data, order + 1)
        for size in range(order, 0, -1):
            level = self.levels[size - 1]
            grams &= np.uint64((1 << 8 * (size + 1)) - 1)
            place = level.symbols.places(grams)
            known = place >= 0
            total += _row_sum(level.bits, place[known])
            grams = grams[~known]
            context = level.contexts.places(grams >> np.uint64(8))
            total += _row_sum(level.escapes, context[context >= 0])
        return total + _row_sum(self.single, (grams & np.uint64(255)).astype(np.int64))


def _row_sum(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return table[rows].sum(axis=0, dtype=np.float64)


def _packed(data: np.ndarray, length: int) -> np.ndarray:
    """Each run of ``length`` bytes as one number."""
    n = len(data) - length + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(length):
        grams = grams << np.uint64(8) | data[k : k + len(grams)]
    return grams


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers with the sums of their counts."""
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which, n, len(distinct))


def _level(size: int, seen: list[tuple[np.ndarray, np.ndarray]], below: np.ndarray, below_keys: np.ndarray | None) -> Level:
    """Contexts of ``size`` bytes from counts ``keys, n`` by language, and the code lengths of the level below.

    Escape method C: a context that was seen n times with d different bytes gives a byte of
    count c the share c / (n + d), and d / (n + d) to the escape. A context that a language has not
    seen passes on for nothing.
    """
    keys = np.unique(np.concatenate([k for k, _ in seen]))
    contexts = np.unique(keys >> np.uint64(8))
    escapes = np.zeros((len(contexts), len(seen)), np.float32)
    bits = np.empty((len(keys), len(seen)), np.float32)
    of_key = np.searchsorted(contexts, keys >> np.uint64(8))
    if below_keys is None:
        shorter = (keys & np.uint64(255)).astype(np.int64)
    else:
        shorter = np.searchsorted(below_keys, keys & np.uint64((1 << 8 * size) - 1))
    for lang, (own, n) in enumerate(seen):
        at = np.searchsorted(contexts, own >> np.uint64(8))
        total, kinds = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
        all_of = np.maximum(total + kinds, 1)
        escapes[:, lang] = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / all_of), 0.0)
        bits[:, lang] = escapes[of_key, lang] + below[shorter, lang]
        place = np.searchsorted(keys, own)
        bits[place, lang] = -np.log2(n / all_of[at])
    return Level(Index(keys), bits, Index(contexts), escapes)


def _grams(samples: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n``: every byte with the ``order`` bytes before it, as one number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(b" " * order + text.as_py(), np.uint8)
                grams.setdefault(lang, []).append(_packed(data, order + 1))
            for lang, found in grams.items():
                codes, n = np.unique(np.concatenate(found), return_counts=True)
                names = pa.array([lang] * len(codes), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return samples.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    parts: int = 3,
    held: int = 1,
    max_docs: int = 3000,
    order: int = ORDER,
    max_cells: int = MAX_CELLS,
) -> Model | None:
    """Fit the context trees on a bounded sample of labelled documents, whole texts.

    Only rows with a language and an id whose crc32 modulo ``parts`` is not ``held`` are used, about
    ``max_docs`` of each language, chosen by a hash of the id. All 256 bytes are told apart. Contexts have
    up to ``order`` bytes (7 at most), or fewer where the code lengths of all languages would be more than
    ``max_cells`` numbers. None if there is nothing to learn from.
    """
    if not 0 <= order <= 7:
        raise ValueError("a context has 0 to 7 bytes")
    ship_package(docs.sparkSession)
    labelled = docs.filter(F.col(f"`{lang_col}`").isNotNull() & not_in_fold(id_col, parts, held)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        whole_bytes(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 30)).alias("draw"),
    )
    # One row per language.
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & (F.col("draw") < int((1 << 30) * min(1.0, max_docs / n))))
    # The sample bounds the table that is collected here.
    table = _grams(labelled.filter(chosen).select("lang", "text"), order).toArrow()
    if not table.num_rows:
        return None
    langs, grams, n = table.column("lang").to_numpy(), table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    languages = sorted(set(langs.tolist()))
    deepest = [(grams[langs == lang], n[langs == lang]) for lang in languages]

    single = np.full((256, len(languages)), 0.0, np.float32)
    levels: list[Level] = []
    below, below_keys, cells = np.full((256, len(languages)), 8.0, np.float32), None, 0
    for size in range(order + 1):
        seen = [_added(g & np.uint64((1 << 8 * (size + 1)) - 1), m) for g, m in deepest]
        level = _level(size, seen, below, below_keys)
        if size == 0:
            # Bytes that no language has seen cost the escape as well.
            single = level.escapes[0] + below
            single[level.symbols.keys.astype(np.int64)] = level.bits
            below = single
            continue
        cells += level.bits.size + level.escapes.size
        if cells > max_cells:
            break
        levels.append(level)
        below, below_keys = level.bits, level.symbols.keys
    return Model(languages, single, levels)


def language(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """A struct ``lang, score, bits`` for each text: the language with the shortest code, its share
    among all languages if each were as likely before, and that code's bits a byte. ``und`` and 0 without
    a letter or a model."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def shortest(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        lang, score, each = [], [], []
        for text in texts:
            if text.as_py() is None or fitted is None:
                lang.append(UNKNOWN)
                score.append(0.0)
                each.append(0.0)
                continue
            bits = fitted.lengths(text.as_py())
            best = int(np.argmin(bits))
            lang.append(fitted.languages[best])
            score.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            each.append(float(bits[best]) / len(text.as_py()))
        columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(each, pa.float64())]
        return pa.StructArray.from_arrays(columns, ["lang", "score", "bits"])

    letters = F.when(whole_text(text_col).rlike(r"\p{L}"), whole_bytes(text_col))
    # A filter on the result must not make Spark judge every text twice.
    return F.arrow_udf(shortest, "struct<lang: string, score: double, bits: double>").asNondeterministic()(letters)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    parts: int = 3,
    held: int = 1,
    order: int = DEEP_ORDER,
    **bounds,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``lang_pred`` is a language that occurs among the documents learnt from, or ``und`` if the
    text is null, empty or without a letter, or if there is nothing to learn from. Rows that
    repeat an id give a row each; a null id is neither learnt from nor held out. An empty table gives
    an empty result. Ties go to the language first in the alphabet. Other columns are not read.
    """
    model = learn(docs, id_col, text_col, lang_col, parts, held, order=order, **bounds)
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        in_fold(id_col, parts, held).alias("held_out"),
        language(docs, model, text_col).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def keep_identified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    languages: Collection[str] | None = None,
    most_bits: float | None = None,
    order: int = DEEP_ORDER,
    **options,
) -> DataFrame:
    """The documents in one of ``languages`` (default: any learnt one), with all columns.

    A document goes if it has no letter, if the model predicts another language, or, with ``most_bits``, if no
    language codes it in fewer bits a byte; ``MOST_BITS`` is what bytes without any language take. A missing
    language is filled with the prediction; languages that are given stay as they are. Without
    a model all texts with a letter stay.
    """
    model = learn(docs, id_col, text_col, lang_col, order=order, **options)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), language(docs, model, text_col).alias("found"))
    if model is None:
        marked = marked.filter(F.col(f"row.`{text_col}`").rlike(r"\p{L}"))
    else:
        marked = marked.filter(F.col("found.lang") != UNKNOWN)
        marked = marked if most_bits is None else marked.filter(F.col("found.bits") < most_bits)
    if languages is not None:
        marked = marked.filter(F.col("found.lang").isin(*languages))
    known = F.nullif(F.col("found.lang"), F.lit(UNKNOWN)).cast(docs.schema[lang_col].dataType)
    filled = F.coalesce(F.col(f"row.`{lang_col}`"), known).alias(lang_col)
    return marked.select(*[filled if c == lang_col else F.col(f"row.`{c}`") for c in docs.columns])
