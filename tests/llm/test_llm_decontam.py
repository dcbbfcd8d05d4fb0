"""Decontamination against a plain search."""

import re

import pytest

from reelmetrics.llm import decontam
from reelmetrics.llm.common import WORD


def _words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _expected(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = _words(text)
        for i in range(max(1, len(words) - window + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = _words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i : i + n]))
                if owners:
                    hit |= set(range(i, i + n))
                    found |= owners
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), len(hit), len(ids), ",".join(ids), bool(hit)))
    return sorted(out, key=repr)


DOCS = [
    (1, "a b c d e f g h i j k l m n"),
    (2, "x a b c d e f g h i j a b c d e f g h i j y"),
    (3, "A, B; C. D! E? F-G H\nI\tJ"),
    (4, "short one here and a short one there"),
    (5, "a a a a a a a a a a a a a"),
    (6, "b c d e f g h i j"),
    (7, None),
    (8, ""),
    (9, "...!!!"),
    (9, "été café short one"),
    (None, "short one"),
    (10, "a b " * 30_000 + "c d e f g h i j"),
]
ITEMS = [
    (10, "a b c d e f g h i j k"),
    (9, "short one"),
    (11, "a a a a a a a a a a a"),
    (11, "café"),
    (12, None),
    (13, "!!!"),
    (None, "there"),
    (14, "a b c d e f g h i j k"),
    (10, "a b c d e f g h i j k"),
]


def _rows(df):
    return sorted(((r.doc_id, *(r.contamination[k] for k in ("n_words", "n_hit", "n_items", "items", "contaminated"))) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [200_000, 4])
def test_small(spark, block):
    docs = spark.createDataFrame([(*d, "x", "y") for d in DOCS], "doc_id bigint, text string, contamination string, places string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert _rows(decontam.contamination(docs, items, block_windows=block)) == _expected(DOCS, ITEMS)
    kept = decontam.drop_contaminated(docs, items, block_windows=block)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in _expected(DOCS, ITEMS) if not r[5]}


def test_tables(spark, docs, odd, nothing):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    for table in (docs, odd, nothing):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        assert _rows(decontam.contamination(table, bench)) == _expected(rows, items)


def test_no_items(spark, docs):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contamination.contaminated for r in decontam.contamination(docs, items).collect())
    assert decontam.drop_contaminated(docs, items).count() == docs.count()


def test_index_needs_no_other_workers(spark, monkeypatch):
    """Rows of the index reach Spark as an Arrow table: no Python workers of another kind are started and stay."""
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")

    def none(*_):
        raise AssertionError("rows are dealt out as pickled objects")

    with monkeypatch.context() as m:
        m.setattr(type(spark.sparkContext), "parallelize", none)
        found = decontam.contamination(docs, items)
    assert _rows(found) == _expected(DOCS, ITEMS)
