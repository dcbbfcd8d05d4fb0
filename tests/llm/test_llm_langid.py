"""Language ID: code lengths against a dictionary model, and held-out accuracy."""

import math
import zlib
from collections import Counter

import pytest

from reelmetrics.llm import langid
from reelmetrics.llm.index import Index


def _bits(train, text):
    """PPM, escape method C, two bytes of context, frozen counts."""
    tables = [Counter(), Counter(), Counter()]
    for t in train:
        data = b"  " + t
        for i in range(2, len(data)):
            for order in range(3):
                tables[order][(data[i - order : i], data[i])] += 1
    total, kinds = Counter(), Counter()
    for table in tables:
        for (context, _), n in table.items():
            total[context] += n
            kinds[context] += 1
    data, bits = b"  " + text, 0.0
    for i in range(2, len(data)):
        for order in (2, 1, 0):
            context = data[i - order : i]
            if not total[context]:
                continue
            n = tables[order][(context, data[i])]
            bits -= math.log2((n or kinds[context]) / (total[context] + kinds[context]))
            if n:
                break
        else:
            bits += 8
    return bits


TRAIN = [("en", "the cat sat on the mat"), ("en", "that is the thing"), ("fr", "le chat été là"), ("fr", "où est le thé")]


@pytest.mark.parametrize("text", ["the chat", "là où", "zzz", "t", "été " * 100, "été " * 100_000])
def test_code_lengths(spark, text):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TRAIN * 3) if zlib.crc32(str(i).encode()) % 3 != 1]
    model = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ["en", "fr"]
    for lang, got in zip(model.languages, model.lengths(text.encode())):
        train = [t.encode() for _, t, own in rows if own == lang]
        if len(text) < 1000:
            assert got == pytest.approx(_bits(train, text.encode()), rel=1e-5)
        assert math.isfinite(got)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_no_rows(spark, odd, nothing):
    rows = langid.identify(odd).collect()
    assert [r.lang_pred for r in rows if r.doc_id in (3, 6, None)] == ["und"] * 4
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr", "de"}
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == 5
    assert langid.identify(nothing).collect() == [] and langid.keep_identified(nothing).collect() == []


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert langid.identify(docs).collect()[0].lang_pred == "und"


def _deep_bits(train, text, order):
    """PPM, escape method C, with any number of bytes of context."""
    tables = [Counter() for _ in range(order + 1)]
    blanks = b" " * order
    for t in train:
        data = blanks + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                tables[k][(data[i - k : i], data[i])] += 1
    total, kinds = Counter(), Counter()
    for table in tables:
        for (context, _), n in table.items():
            total[context] += n
            kinds[context] += 1
    data, bits = blanks + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            context = data[i - k : i]
            if not total[context]:
                continue
            n = tables[k][(context, data[i])]
            bits -= math.log2((n or kinds[context]) / (total[context] + kinds[context]))
            if n:
                break
        else:
            bits += 8
    return bits


SCRIPTS = {
    "el": "\u03b7 \u03b3\u03ac\u03c4\u03b1 \u03ba\u03ac\u03b8\u03b5\u03c4\u03b1\u03b9", "ru": "\u043a\u043e\u0448\u043a\u0430 \u0441\u0438\u0434\u0438\u0442", "ar": "\u0627\u0644\u0642\u0637 \u064a\u062c\u0644\u0633",
    "he": "\u05d4\u05d7\u05ea\u05d5\u05dc \u05d9\u05d5\u05e9\u05d1", "hi": "\u092c\u093f\u0932\u094d\u0932\u0940 \u092c\u0948\u0920\u0940", "th": "\u0e41\u0e21\u0e27\u0e19\u0e31\u0e48\u0e07", "zh": "\u732b\u5750\u5728\u57ab\u5b50\u4e0a",
    "ja": "\u732b\u304c\u3044\u307e\u3059", "ko": "\uace0\uc591\uc774\uac00 \uc549\ub2e4", "fr": "le chat s'assied l\u00e0", "en": "".join(map(chr, range(32, 127))),
}


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_all_bytes_and_any_order(spark, order):
    """Eleven scripts use more bytes than half of all; every code length is exact."""
    rows = [(i, f"{text} {k}" * (1 + k % 2), lang) for k in range(4) for i, (lang, text) in enumerate(SCRIPTS.items(), 100 * k)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert len(set("".join(r[1] for r in rows).encode())) > 150
    model = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), order=order)
    assert len(model.levels) == order
    texts = [*SCRIPTS.values(), "\x00\x01 z\u00fc \U0001f600", "a", "\u732b\u5750 le chat \u043a\u043e"]
    for text in texts:
        for lang, got in zip(model.languages, model.lengths(text.encode())):
            assert got == pytest.approx(_deep_bits([t.encode() for _, t, own in rows if own == lang], text.encode(), order), rel=1e-5)


def test_blocks_and_bounds(spark, monkeypatch):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TRAIN * 3) if zlib.crc32(str(i).encode()) % 3 != 1]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.learn(df, order=4)
    text = ("the chat \u00e9t\u00e9 " * 50).encode()
    whole = model.lengths(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert model.lengths(text) == pytest.approx(whole, rel=1e-6)
    cells = sum(level.bits.size + level.escapes.size for level in model.levels[:2])
    assert len(langid.learn(df, order=4, max_cells=cells).levels) == 2
    with pytest.raises(ValueError):
        langid.learn(df, order=8)


def test_index():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(1 << 20))
        index = Index(keys)
        assert (index.places(keys) == np.arange(len(keys))).all()
        assert (index.places(keys + np.uint64(1)) == -1).all()


def test_the_prediction_decides(spark):
    """Other languages and texts without any go, missing languages are filled, given ones stay."""
    rows = [(i, f"{t} number {i}" if lang == "en" else f"{t} num\u00e9ro {i}", lang) for i, (lang, t) in enumerate(TRAIN * 30)]
    rows += [(1000, "the cat sat on that thing", None), (1001, "le chat est l\u00e0 o\u00f9", None), (1002, "the mat", "fr"), (1003, "\u00b5\U0001f600" * 9 + "q", None), (1004, "--", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, found string")
    kept = {r.doc_id: r.lang for r in langid.keep_identified(docs, most_bits=langid.MOST_BITS).collect()}
    assert (kept[1000], kept[1001], kept[1002]) == ("en", "fr", "fr")
    assert 1003 not in kept and 1004 not in kept and len(kept) == len(TRAIN) * 30 + 3
    english = langid.keep_identified(docs, languages=["en"])
    assert english.columns == docs.columns
    assert {1000, 1002} <= {r.doc_id for r in english.collect()} and 1001 not in {r.doc_id for r in english.collect()}
