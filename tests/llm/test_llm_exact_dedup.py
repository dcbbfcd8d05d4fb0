"""Exact copies against grouping in plain Python."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from reelmetrics.llm import exact_dedup


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _expected(rows, pick):
    groups = defaultdict(list)
    for i, text in rows:
        groups[_lower(text)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = [True] + [False] * (ids.count(keep) - 1)
        out += [(i, keep, len(ids), kept.pop(0) if i == keep else False, sha) for i in ids]
    return sorted(out, key=repr)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert _rows(exact_dedup.copy_groups(docs, keep="largest")) == _expected(rows, max)
    assert _rows(exact_dedup.copy_groups(docs)) == _expected(rows, min)


def test_odd_rows_and_no_rows(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert _rows(exact_dedup.copy_groups(odd, keep="largest")) == _expected(rows, max)
    assert exact_dedup.copy_groups(nothing).collect() == []
    assert exact_dedup.drop_copies(nothing).columns == nothing.columns


def test_collisions_are_told_apart(docs):
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 5), 2, "0"))
    strong = _rows(exact_dedup.copy_groups(docs, keep="largest"))
    assert _rows(exact_dedup.copy_groups(docs, keep="largest", content_hash=weak)) == strong


def test_without_broadcast(docs):
    assert _rows(exact_dedup.copy_groups(docs, broadcast_hashes=0)) == _rows(exact_dedup.copy_groups(docs))


def test_one_row_per_text_stays(docs, odd):
    for table in (docs, odd):
        left = exact_dedup.drop_copies(table, keep="largest")
        assert left.columns == table.columns
        texts = [_lower(r["text"]) for r in left.collect()]
        assert len(texts) == len(set(texts))
        assert set(texts) == {_lower(r["text"]) for r in table.collect()}
