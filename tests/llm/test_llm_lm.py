"""Language model: counts and scores against dictionaries, and a proper distribution."""

import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from reelmetrics.llm import lm

SIZE = lm.Size(words=40, arcs=60, least_count=2)


def _tokens(text):
    return (text or "").encode().lower().split()


class Backoff:
    """The same model by dictionaries: trigrams, bigrams, unigrams."""

    def __init__(self, texts, size):
        self.one = Counter(t for x in texts for t in [*_tokens(x), b""])
        self.scale = sum(self.one.values()) + len(self.one) + 1
        self.number = set(self._most({w: n for w, n in self.one.items() if w}, size.words)) | {b"", "start"}
        two, three = Counter(), Counter()
        framed = [["start", *_tokens(x), b""] for x in texts]
        for f in framed:
            two.update((a, b) for a, b in zip(f, f[1:]) if a in self.number and b in self.number)
        self.two = self._most({g: n for g, n in two.items() if n >= size.least_count}, size.arcs)
        for f in framed:
            three.update(g for g in zip(f, f[1:], f[2:]) if g[:2] in self.two and g[1:] in self.two)
        self.three = self._most({g: n for g, n in three.items() if n >= size.least_count}, size.arcs)
        self.starts, self.d = len(texts), size.discount

    def _most(self, counts, limit):
        """All from the least count on that leaves no more than the limit."""
        cut = min((c for c in counts.values() if sum(n >= c for n in counts.values()) <= limit), default=math.inf)
        return {g: n for g, n in counts.items() if n >= cut}

    def p(self, word, history):
        if not history:
            return (self.one[word] + 1) / self.scale
        table = self.three if len(history) == 2 else self.two
        arcs = {g[-1]: n for g, n in table.items() if g[:-1] == history}
        if not arcs:
            return self.p(word, history[1:])
        total = self.two[history] if len(history) == 2 else self.starts if history == ("start",) else self.one[history[0]]
        if word in arcs:
            return (arcs[word] - self.d) / total
        left = 1 - sum(n - self.d for n in arcs.values()) / total
        return left / (1 - sum(self.p(w, history[1:]) for w in arcs)) * self.p(word, history[1:])

    def score(self, text):
        out, history = 0.0, ("start",)
        for t in [*_tokens(text), b""]:
            out += math.log10(self.p(t, history))
            history = (*history, t)[-2:]
        return out


def _check(table, size):
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    held = {i: None if i is None else zlib.crc32(str(i).encode()) % 7 for i, _ in rows}
    model = Backoff([t for i, t in rows if held[i] not in (None, 2)], size)
    n = sum(model.one.values())
    expected = []
    for i, text in rows:
        tokens = [*_tokens(text), b""]
        base = sum(math.log10((model.one[t] + 1) / model.scale) for t in tokens)
        expected.append((i, held[i] == 2, len(tokens), sum(model.one[t] > 0 for t in tokens), n, base, model.score(text)))
    got = sorted(map(tuple, lm.lm_scores(table, size=size).collect()), key=repr)
    expected.sort(key=repr)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5:] for g in got], [e[5:] for e in expected])
    return model


WORDS = "the cat sat on a mat and the dog ate THE cat".split()


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, rng.integers(0, 12))) + (" rare%d" % (i % 9)) for i in range(60)]
    rows = [*enumerate(texts), (100, None), (101, ""), (101, "\t\v the cat"), (None, "the cat")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("size", [SIZE, lm.Size(words=3, arcs=4, least_count=1), lm.Size(words=0, arcs=0, least_count=1), lm.Size(least_count=1)])
def test_small(small, size):
    _check(small, size)


def test_probabilities_sum_to_one(small):
    model = _check(small, SIZE)
    for history in [(), ("start",), (b"the",), (b"the", b"cat"), ("start", b"the"), (b"never",)]:
        total = sum(model.p(w, history) for w in [*model.one, b"one that was never seen"])
        assert total == pytest.approx(1, abs=1e-9)


def test_odd_rows_and_no_rows(spark, odd, nothing):
    _check(odd, SIZE)
    assert lm.lm_scores(nothing).collect() == []
    one = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    alone = lm.lm_scores(spark.createDataFrame([(one, "a b")], "doc_id bigint, text string")).collect()[0]
    assert (alone.train_tokens, alone.n_known, alone.n_tokens, alone.score) == (0, 0, 3, 0.0)


def test_better_than_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.lm_scores(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


@pytest.mark.parametrize("near", [(0, 0), (3, 2)])
def test_ngrams_that_are_not_broadcast_are_joined(small, near):
    size = lm.Size(least_count=1, near_words=near[0], near_arcs=near[1])
    model = _check(small, size)
    assert len(model.two) > 10 and len(model.three) > 10


def test_no_ngram_is_cut():
    """Before, 200,000 words and 300,000 bigrams and trigrams were all."""
    assert lm.Size().words == lm.Size().arcs == math.inf


def test_a_task_counts_in_little_memory():
    """Two workers and a heap share an executor's memory: the arrays of a block stay below 80 MB."""
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(400)).encode() for _ in range(3200)]
    assert sum(map(len, texts)) > 4_000_000
    run = next(lm.blocks(iter(texts), lm.BLOCK))
    tracemalloc.start()
    try:
        block = lm._Block.of(run, 0)
        at = block.pairs()
        lm._distinct(block.which[at], block.which[at + 1])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 << 20


def test_look_ups_move_in_wide_rows():
    """Before, every n-gram to look up was a row of its own; now a bucket is, whatever number of texts asks."""
    asks = [np.repeat(np.arange(100), 100), np.arange(10_000) % 5_000 << 50]
    numbers = [np.zeros(100, np.int64), np.zeros(100, np.int64), np.zeros(100), np.zeros(100)]
    model = SimpleNamespace(value=SimpleNamespace(scored=lambda run: (numbers, asks)))
    batch = pa.table({"row": np.arange(100), "own": np.arange(100), "text": [b""] * 100}).to_batches()
    rows = pa.Table.from_batches(lm._walked(model, 3)(iter(batch))).to_pylist()
    assert len(rows) <= 100 + 2**3
    found = [(k, p, t) for r in rows if r["keys"] for k, p, t in zip(*(np.frombuffer(r[c], d).tolist() for c, d in (("keys", "i8"), ("places", "u2"), ("asked", "i4"))))]
    want = Counter(zip(asks[1].tolist(), asks[0].tolist()))
    assert sorted(found) == sorted((k, p, n) for (k, p), n in want.items())


def test_counts_add_up_when_sort_keys_meet():
    """Words whose first bits are equal have one sort key and may lie mixed."""
    rng = np.random.default_rng(4)
    grams = [rng.integers(0, 3, 500), rng.integers(0, 3, 500)]
    bucket, words, n = lm._added(grams, np.ones(500, np.int64), 3)
    assert (np.diff(bucket.astype(int)) >= 0).all()
    got = dict(zip(zip(*(w.tolist() for w in words)), n.tolist()))
    assert len(got) == len(n) and got == Counter(zip(*(g.tolist() for g in grams)))


def test_look_ups_are_not_copied():
    """Before, the look-ups of a bucket were copied whole before the first was read, beside what Spark had sent."""
    keys = np.arange(100_000, dtype=np.uint64)
    places, times = (keys % 50).astype(np.uint16), np.ones(len(keys), np.int32)
    asks = {"keys": keys.tobytes(), "places": places.tobytes(), "asked": times.tobytes()}
    text = {"home": 0, "at": 7, "own": 70, "times": 3, "known": 2, "base": -1.0, "score": -2.0}
    kinds = [pa.field(c, pa.int64()) for c in ("bucket", "home", "at", "own", "times", "known")] + [pa.field(c, pa.float64()) for c in ("base", "score")]
    rows = [{"bucket": 1, "home": k, **asks} for k in range(20)] + [{"bucket": 1, **text}]
    walked = pa.Table.from_pylist(rows, pa.schema([*kinds, *(pa.field(c, pa.binary()) for c in asks)]))
    gain = {"keys": keys[:2].tobytes(), "known": np.ones(2, np.int32).tobytes(), "base": np.ones(2).tobytes(), "gain": np.full(2, 2.0).tobytes()}
    gains = pa.Table.from_pylist([gain])
    pool, before = pa.proxy_memory_pool(pa.default_memory_pool()), pa.default_memory_pool()
    pa.set_memory_pool(pool)
    try:
        found = lm._looked_up(walked, gains).to_pylist()
    finally:
        pa.set_memory_pool(before)
    assert pool.max_memory() < walked.nbytes // 10
    assert [{k: r[k] for k in text} for r in found if r["places"] is None] == [text]
    more = [r for r in found if r["places"] is not None]
    assert sorted(r["home"] for r in more) == list(range(20))
    assert all(np.frombuffer(r["places"], "u2").tolist() == [0, 1] and np.frombuffer(r["more_gain"]).tolist() == [2.0, 2.0] for r in more)
