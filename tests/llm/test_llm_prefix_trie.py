"""The conversation trie against plain dictionaries."""

import hashlib
import random
import zlib

import pytest

from reelmetrics.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = c % 100 if c >= 0 else -(-c % 100)
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def _nodes(rows):
    seqs = _rebuilt(rows)
    members, kids = {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    total = {}
    for key in sorted(members, key=len, reverse=True):
        below = [total[k] for k in kids.get(key, [])]
        saved = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        total[key] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    found = []
    for key, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(key), parent, len(convs), len(kids.get(key, [])), *total[key], digest))
    return sorted(found, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def _random(seed, n=60):
    """Conversations with common beginnings, equal ones, and long ones."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 350), n):
        length = rng.choice([1, 2, 3, 4, 6, 8, 20])
        rows += [(c, k, rng.choice("us"), rng.choice(["", "a", "ab", "é\U0001f600"])) for k in range(length)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("burst", [1, 7, 1000])
def test_random_conversations(spark, burst):
    rows = _random(burst)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(prefix_trie.conversation_trie(df, burst)) == _nodes(rows)


@pytest.mark.parametrize("burst", [3, 1000])
def test_equal_and_hot_conversations(spark, burst):
    """Most conversations start alike or are equal; some are left without a turn."""
    rows = [(c, k, "user", f"t{k}" if k < 7 or c % 3 else f"{c}") for c in range(1000, 1120) for k in range(9)]
    rows += [(c, 0, "user", "alone") for c in range(2001, 2030)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = _nodes(rows)
    assert any(n[1] == 0 and n[3] > 100 for n in want)
    assert _got(prefix_trie.conversation_trie(df, burst)) == want


@pytest.mark.parametrize("burst", [1, 1000])
def test_odd_rows(spark, burst):
    rows = [
        (None, 1, "user", "x"), (None, None, None, None), (5, None, "user", None), (5, 1, None, "x"), (5, 1, None, "x"),
        (5, 0, "a", ""), (0, None, None, None), (0, 3, "u", "y" * 50_000), (7, 2, "u", "y" * 50_000), (7, 2, "u", "z"),
        (7, 2, "t", "z"), (-3, 1, "u", "n"), (205, 1, "u", "n"), (205, 2, "u", "n"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", depth string, place int, x1 int")
    # Turns that tie in number and role are ordered by a hash, the plain model by text.
    ties = [r for r in rows if r[0] != 7 or r[2] != "u"]
    assert _got(prefix_trie.conversation_trie(df.filter("NOT (conv_id <=> 7 AND role <=> 'u')"), burst)) == _nodes(ties)
    whole = prefix_trie.conversation_trie(df, burst)
    assert _got(whole) == _got(prefix_trie.conversation_trie(df.repartition(3), burst))
    assert whole.filter("depth = 0").first().n_convs == 5


def test_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).collect() == []


def test_prefixes_over_chunks(spark, monkeypatch):
    """A conversation that is longer than a chunk gets the same nodes."""
    rows = [(c, k, "u", str(k if c < 3 or k < 40 else -k)) for c in range(4) for k in range(50)]
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    assert _got(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), 2)) == _nodes(rows)
