"""The n-gram Jaccard join against sets in plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelmetrics.llm import ngram_join, wordhash

SCHEMA = "doc_id bigint, text string"


def _set(text, k=3):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def _plain(rows, percent=90):
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
                links += 1
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr), links


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want, links = _plain(rows)
    assert _got(ngram_join.similar_components(df, **options)) == want
    return links


def _prose(rng, n, vocabulary=500):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_tokens():
    rng = random.Random(1)
    texts = ["", "  \n", "one", "One  two", "a b c a b c", "é É é", "x" * 1000 + " y z", "\x00 \x0b\x0c b \x1c c", "\x00", "\x00\x00"]
    texts += [" ".join(_prose(rng, n, 9)) for n in range(3, 60)] + ["w " * 5 + "v" * n for n in (7, 8, 9, 15, 16, 17, 255, 256, 257, 3000)]
    texts += [f"{'a' * n}b {'a' * n}c {'a' * n}" for n in range(20)]
    seen = {}
    for t in texts:
        tokens = ngram_join.shingle_set(t.encode())
        assert len(tokens) == len(_set(t)) and (np.diff(tokens.astype(object)) > 0).all()
        assert seen.setdefault(frozenset(_set(t)), tokens.tolist()) == tokens.tolist()
    assert len({tuple(v) for v in seen.values()}) == len(seen)
    words = {w for t in texts for w in t.lower().encode().split()}
    hashes = {w: wordhash.word_hashes(w).tolist() for w in words}
    assert len({tuple(h) for h in hashes.values()}) == len(words)
    joined = sorted(words)
    assert wordhash.word_hashes(b" ".join(joined)).tolist() == [hashes[w][0] for w in joined]


def test_prefix_is_enough():
    """Similar sets share a token among their first under any order."""
    rng = random.Random(2)
    for _ in range(3000):
        n = rng.randrange(1, 40)
        x = set(range(n))
        y = set(list(x)[: n - rng.randrange(0, 3)]) | {n + k for k in range(rng.randrange(0, 3))}
        if 100 * len(x & y) >= 90 * len(x | y):
            order = rng.sample(range(n + 3), n + 3)
            first = [sorted(s, key=order.index)[: ngram_join.prefix_size(len(s))] for s in (x, y)]
            assert set(first[0]) & set(first[1])


def test_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _got(ngram_join.similar_components(docs)) == _plain(rows)[0]


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed):
    """Copies with edits around the threshold, chains of them, and short texts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        words = _prose(rng, rng.choice([1, 2, 3, 5, 30, 60, 100, 200]))
        for _ in range(rng.choice([1, 2, 10])):
            words = _edited(rng, words, rng.choice([0, 0, 1, 2, 3]))
            rows.append((rng.randrange(10**6), " ".join(words)))
    assert _check(spark, rows) > 10


def test_near_copies_and_common_passages(spark):
    """A group of near copies, of which only some pairs link, and a passage that half of all texts hold."""
    rng = random.Random(5)
    base, passage = _prose(rng, 120, 10**6), _prose(rng, 60, 10**6)
    rows = [(i, " ".join(_edited(rng, base, rng.choice([1, 2, 3, 4])))) for i in range(150)]
    rows += [(1000 + i, " ".join(passage + _prose(rng, 40, 10**6))) for i in range(150)]
    rows += [(2000 + i, " ".join(passage)) for i in range(50)]
    assert _check(spark, rows) > 1000


@pytest.mark.parametrize("open_pairs", [10**9, 1])
def test_leaders_give_the_same_links_as_all_pairs(spark, monkeypatch, open_pairs):
    """Rounds with leaders as long as they find links, or all pairs at once."""
    rng = random.Random(6)
    base = _prose(rng, 100, 10**6)
    rows = [(i, " ".join(_edited(rng, base, rng.choice([2, 3, 4])))) for i in range(80)]
    sizes, called = ngram_join._label_sizes, []
    monkeypatch.setattr(ngram_join, "_label_sizes", lambda *a: called.append(1) or sizes(*a).withColumn("open", F.col("open") * 0 + open_pairs))
    assert _got(ngram_join.similar_components(spark.createDataFrame(rows, SCHEMA))) == _plain(rows)[0]
    assert len(called) == 1 if open_pairs == 1 else len(called) > 1


def test_rarity(spark, monkeypatch):
    """Counts are those of different texts; only the most frequent are entered."""
    rows = [(k, -k, ("common words here " + " ".join(f"{k}a {k}b {k}c" for _ in range(2))).encode()) for k in range(50)]
    rows += [(1000, 0, b"second common passage"), (1001, 0, b"second common passage x")] + rows[:10]
    texts = spark.createDataFrame(rows, "k1 bigint, k2 bigint, text binary").coalesce(1)
    table = ngram_join.rarity_table(texts)
    token = {t: ngram_join._counters(ngram_join.shingle_set(t))[0] for t in (b"common words here", b"second common passage", b"0a 0b 0c")}
    assert [table[token[t]] for t in token] == [int(np.log2(50) * 8), 8, 0]
    assert (ngram_join.rarity_table(texts, most=1) > 0).sum() == 1


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _got(ngram_join.similar_components(odd)) == _plain(rows)[0]


def test_nothing(spark, nothing):
    assert ngram_join.similar_components(nothing).collect() == []
    empty = spark.createDataFrame([(3, None), (1, ""), (2, " \n"), (None, None)], SCHEMA)
    assert _got(ngram_join.similar_components(empty)) == sorted([(3, 0, 3), (1, 0, 1), (2, 0, 2), (None, 0, None)], key=repr)


def test_sketches_keep_similar_sets():
    """Sketches differ in no more bits than sets have tokens apart, and tell others apart."""
    rng = np.random.default_rng(7)
    for n in (1, 5, 40, 300, 5000):
        tokens = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        for apart in {0, 1, n // 10, n}:
            x, y = ngram_join.sketch(tokens[:n]), ngram_join.sketch(tokens[apart : n + apart])
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= 2 * apart
    x, y = (ngram_join.sketch(rng.integers(0, 1 << 63, 300).astype(np.uint64)) for _ in range(2))
    assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) * 190 > 600 * 10


def test_tokens_move_in_wide_rows():
    """Before, every token of a text was a row of 8 bytes and more; now a bucket is, with 4 bytes for a token."""
    texts = [" ".join(_prose(random.Random(k), 400, 10**6)).encode() for k in range(50)]
    batch = pa.table({"k1": range(50), "k2": range(50), "text": texts}).to_batches()
    rows = pa.Table.from_batches(ngram_join._all_tokens(3)(iter(batch))).to_pylist()
    assert len(rows) <= 2**ngram_join.BUCKET_BITS
    assert sum(len(r["tokens"]) for r in rows) == 4 * 50 * 398


def test_pairs_that_sketches_tell_apart_are_no_rows(spark, monkeypatch):
    """Before, all pairs of large buckets became rows that met their sketches in two more joins."""
    rng = random.Random(9)
    texts = [_prose(rng, 90, 5) for _ in range(120)]
    texts += [_edited(rng, t, 1) for t in texts[:20]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sizes, pairs, left, listed = ngram_join._label_sizes, ngram_join._all_pairs, [], []

    def seen_sizes(*a):
        left.append(sizes(*a).agg(F.sum("open")).first()[0])
        return sizes(*a)

    def seen_pairs(*a):
        listed.append(pairs(*a).count())
        return pairs(*a)

    monkeypatch.setattr(ngram_join, "_label_sizes", seen_sizes)
    monkeypatch.setattr(ngram_join, "_all_pairs", seen_pairs)
    assert _check(spark, rows) >= 10
    assert left[0] > 5000
    assert sum(listed) < 200


def test_rarity_takes_few_jobs(spark, monkeypatch):
    """Slices are not fetched partition by partition, a job each."""
    rng = random.Random(7)
    rows = [(i, i, " ".join(_prose(rng, 60, 50)).encode()) for i in range(200)]
    texts = spark.createDataFrame(rows, "k1 bigint, k2 bigint, text binary")
    options = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("rarity", "rarity")
        table = ngram_join.rarity_table(texts)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    counts = {}
    for _, _, text in rows:
        for token in ngram_join.shingle_set(text).tolist():
            counts[token] = counts.get(token, 0) + 1
    want = np.zeros_like(table)
    for token, n in counts.items():
        slot = int(ngram_join._counters(np.array([token], np.uint64))[0])
        want[slot] = max(want[slot], int(np.floor(np.log2(n) * 8)))
    assert want.any() and (table == want).all()
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("rarity")) < 20


def test_a_round_without_links_leaves_the_members(spark, monkeypatch):
    """Members of buckets are stored anew only after new links."""
    stores = []
    mixed = ngram_join._mixed
    monkeypatch.setattr(ngram_join, "_mixed", lambda *a: stores.append(1) or mixed(*a))
    mates = spark.createDataFrame([(1, i, i, 10, 0) for i in range(12)], "token bigint, k1 bigint, k2 bigint, n bigint, at bigint")
    lists = [list(range(100 * (i // 2), 100 * (i // 2) + 10)) for i in range(12)]
    sets = spark.createDataFrame(
        [(i, i, x, x[:3], x[:3], [0] * ngram_join.SKETCH) for i, x in enumerate(lists)],
        "k1 bigint, k2 bigint, tokens array<bigint>, a array<bigint>, b array<bigint>, sketch array<bigint>",
    )
    # The leader of the first round finds its twin, those of the second nothing; all pairs find the others.
    labels = ngram_join.similar_links(mates, sets).collect()
    assert sorted(map(tuple, labels)) == [(i, i, i // 2 * 2, i // 2 * 2) for i in range(12)]
    assert len(stores) == 1
