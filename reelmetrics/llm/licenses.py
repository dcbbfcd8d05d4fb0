"""License scan: exact phrases, and an exact set-similarity join with license templates.

Native: only DataFrame functions. A block is any run of as many words as the template has, and a quarter
more, wherever it begins and whatever lines it spans; a template is contained in a block as far as its
distinct words occur there. So a notice is found however it is wrapped, and words that are
scattered over a long text make none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import NOT_WORD, lower_ascii, stored, whole_text

# The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that license texts themselves recommend.
TEMPLATES = {
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "apache-notice": "licensed under the apache license version 2 0",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files to deal in the software without restriction",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
}


def _words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(F.regexp_replace(text, NOT_WORD, " "), " "), lambda w: w != "")


def _starts(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after the other."""
    parts = phrase.split(" ")

    def at(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return F.coalesce(found, F.lit(False))

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)
    nothing = F.array().cast("array<int>")
    # An array of few documents is searched place by place: those with the rarest word.
    rarest = max(parts, key=len)
    return F.when(F.array_contains(words, rarest), places).otherwise(nothing)


def _min_overlap(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def block_words(template: str) -> int:
    """The words of a block for a template: its own, and a quarter more."""
    return math.ceil(len(template.split()) * 1.25)


def _distinct_words(docs: DataFrame, text_col: str, vocabulary: list[str]) -> DataFrame:
    """Per text its distinct words that any template has."""
    known = F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")
    return docs.select(F.array_intersect(_words(lower_ascii(whole_text(text_col))), known).alias("tokens"))


def template_matches(
    docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = 0.8
) -> DataFrame:
    """``key, label, start, containment`` for each text and template with a block of at least ``threshold``.

    ``key`` is the SHA-256 of the lower-cased text; ``containment`` is the largest share of the template's distinct
    words that a block holds, and ``start`` where the first such block begins that begins with one of them (words
    from 0). The join is exact. Words are ordered by the number of texts that have them, the rarest
    first; a block that holds o of a template's m words has one of its m - o + 1 rarest, so blocks
    around these alone are looked at. The length filter drops surroundings with fewer than o of the
    template's words, the positional one those that can't reach o words beside the one that is
    met: it has a place in the template's order, and what is rarer must be there as well to count.
    Repeated texts give one row; null is the empty text, which has no match. Templates without words
    never match.
    """
    texts = {label: t.split() for label, t in (TEMPLATES if templates is None else templates).items() if t.split()}
    spark = docs.sparkSession
    none = "key binary, label string, start int, containment double"
    if not texts:
        return spark.createDataFrame([], none)
    words = {label: sorted(set(t)) for label, t in texts.items()}
    vocabulary = sorted({w for tokens in words.values() for w in tokens})
    # At most one row per word of the templates.
    counts = {r[0]: r[1] for r in _distinct_words(docs, text_col, vocabulary).select(F.explode("tokens")).groupBy("col").count().collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}

    prefixes = []
    for label, tokens in words.items():
        ranked, least = sorted(tokens, key=order.__getitem__), _min_overlap(len(tokens), threshold)
        size = block_words(" ".join(texts[label]))
        prefixes += [(w, i, least, size, ranked, label) for i, w in enumerate(ranked[: len(ranked) - least + 1])]
    prefix = spark.createDataFrame(prefixes, "word string, at int, least int, size int, ranked array<string>, label string")
    rare = F.array(*[F.lit(w) for w in sorted({p[0] for p in prefixes})])
    widest = max(p[3] for p in prefixes)

    # Each place of a rare word with the words around it, so far as any block that holds it can reach.
    text = lower_ascii(whole_text(text_col))
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("place")))
    around = F.slice("words", F.greatest(F.col("found.place") - widest + 2, F.lit(1)), F.least(F.col("found.place"), F.lit(widest - 1)) + widest)
    met = (
        docs.select(text.alias("text"))
        .select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), _words(F.col("text")).alias("words"))
        .filter(F.arrays_overlap("words", rare))
        .select("key", "words", F.explode(F.filter(numbered, lambda x: F.array_contains(rare, x["word"]))).alias("found"))
        .select("key", "found.word", "found.place", around.alias("around"))
    )
    # The templates bound the prefix table: one row per word of a template at most.
    first = F.greatest(F.col("place") - widest + 1, F.lit(0))
    near = F.slice("around", F.greatest(F.col("place") - first - F.col("size") + 2, F.lit(1)), F.least(F.col("place") - first, F.col("size") - 1) + F.col("size"))
    joined = met.join(F.broadcast(prefix), "word").select(
        "key", "label", "at", "least", "size", "ranked", "place", near.alias("near"), F.greatest(F.col("place") - F.col("size") + 1, F.lit(0)).alias("first")
    )
    rarer = F.size(F.array_intersect("near", F.slice("ranked", F.lit(1), F.col("at"))))
    reach = rarer + F.size("ranked") - F.col("at")
    fitting = joined.filter((F.size(F.array_intersect("near", "ranked")) >= F.col("least")) & (reach >= F.col("least")))
    # Blocks that hold the place and begin with a word of the template.
    begins = F.filter(F.sequence(F.lit(0), F.col("place") - F.col("first")), lambda i: F.array_contains("ranked", F.get("near", i)))
    shares = F.transform(begins, lambda i: F.struct(F.size(F.array_intersect(F.slice("near", i + 1, F.col("size")), "ranked")).alias("n"), (-i).alias("i")))
    best = fitting.select("key", "label", "least", "first", F.size("ranked").alias("m"), F.array_max(shares).alias("best"))
    return (
        best.filter(F.col("best.n") >= F.col("least"))
        .groupBy("key", "label")
        .agg(F.max(F.struct(F.col("best.n").alias("n"), (F.col("best.i") - F.col("first")).alias("i"), "m")).alias("top"))
        .select("key", "label", (-F.col("top.i")).alias("start"), (F.col("top.n") / F.col("top.m")).alias("containment"))
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    The base columns count the places of ``PHRASES``; ``labels`` adds the labels of the matching
    templates. ``score`` is 1 with a base place, else the best containment that meets the
    threshold, else 0. Null text counts as empty; rows that repeat an id or a text give a row
    each; a null id stays null; an empty table gives an empty result. Other columns are not read.
    """
    matches = stored(
        template_matches(docs, text_col, templates, threshold)
        .groupBy("key")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment")),
        "license-matches",
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), lower_ascii(whole_text(text_col)).alias("text")).select(
        "doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), _words(F.col("text")).alias("words")
    )
    places = {label: _starts(F.col("words"), phrase) for phrase, label in PHRASES.items()}
    scanned = rows.select("doc_id", "key", F.size("words").cast("bigint").alias("n_words"), *[c.alias(f"in_{k}") for k, c in places.items()])
    every = F.concat(*[F.col(f"`in_{k}`") for k in places])
    # The entries are null where a label has no place.
    base = F.array_compact(F.array(*[F.when(F.size(f"`in_{k}`") > 0, F.lit(k)) for k in places]))
    return (
        scanned.select("doc_id", "key", "n_words", every.alias("every"), F.array_sort(base).alias("base"))
        .join(matches, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.size("every").cast("bigint").alias("n_base"),
            F.array_min("every").cast("bigint").alias("first_word"),
            F.array_max("every").cast("bigint").alias("last_word"),
            F.concat_ws(",", "base").alias("base_labels"),
            F.concat_ws(",", F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))).alias("labels"),
            F.when(F.size("every") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        )
    )
