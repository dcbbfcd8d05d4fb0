"""SimHash: fingerprints, keys and components against brute force."""

import random

import numpy as np
import xxhash

from reelmetrics.llm import components, simhash

BLANKS = " \t\n\v\f\r"


def _fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in BLANKS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows, max_bits=4):
    prints = [_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted(((doc, f"{prints[i]:016x}", least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def test_codewords_near_two_words_meet():
    patterns = simhash._error_patterns()
    assert {len(set(row)) for row in patterns.tolist()} == {1, 6}
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300)
    keys = simhash.golay_keys(words, patterns)
    for a in range(23):
        for b in range(a, 23):
            other = simhash.golay_keys(words ^ (1 << a) ^ ((1 << b) if b > a else 0), patterns)
            assert (keys[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


def test_fingerprints_within_four_bits_share_a_key():
    rng, patterns = random.Random(2), simhash._error_patterns()
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        keys, owners = simhash.segment_keys(np.array([a, b], np.uint64), patterns)
        assert set(keys[owners == a]) & set(keys[owners == b])


def test_links_span_what_all_pairs_connect(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            prints.add(x)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    table = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    rooted = dict(map(tuple, components.components(simhash.near_links(table)).collect()))
    got = {}
    for x in signed:
        got.setdefault(rooted.get(x, x), set()).add(x)
    expected, left = [], dict(zip(prints, signed))
    while left:
        group, new = set(), [next(iter(left))]
        while new:
            x = new.pop()
            if x in left:
                group.add(left.pop(x))
                new += [y for y in left if (x ^ y).bit_count() <= 4]
        expected.append(group)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected))


def test_large_buckets(monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 62)
    prints = np.unique(np.array([centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (500, 2))], np.uint64))
    monkeypatch.setattr(simhash, "PAIRS", 1000)
    links = simhash.spanning_links(prints, 4)
    assert len(links) == len(prints) - 1 and len({b for _, b in links}) == len(links)


def test_tables(docs, odd, nothing):
    for table in (docs, odd, nothing):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        got = simhash.near_components(table).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted(map(tuple, got), key=repr) == _components(rows)


def test_one_of_each_component_stays(docs, odd):
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    roots = {r[2] for r in _components([tuple(r) for r in docs.select("doc_id", "text").collect()])}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(roots)
    assert simhash.drop_near_copies(odd).columns == odd.columns


def test_chain_of_components(spark):
    order = list(range(200))
    random.Random(5).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 501), (7, 7)], "a bigint, b bigint")
    got = dict(map(tuple, components.components(links).collect()))
    assert got == {**{i: 0 for i in range(200)}, 500: 500, 501: 500}


def test_a_hot_key_is_split(spark):
    """100,000 fingerprints that share a key are compared in many tasks, with equal components."""
    rng = np.random.default_rng(8)
    # The first segment and the low half of the second one are the same for all.
    free = rng.integers(0, 1 << 31, 100_000).astype(np.uint64)
    prints = np.unique((free << np.uint64(33)) | np.uint64(0x1_5A5A_5A5A))
    near = np.unique(np.concatenate([prints, prints[:500] ^ np.uint64(1 << 40), prints[:500] ^ np.uint64(7 << 40)]))
    df = spark.createDataFrame([(int(x),) for x in near.view(np.int64)], "fp bigint")
    whole = spark.createDataFrame([(1, int(x)) for x in near.view(np.int64)], "key bigint, fp bigint")
    tasks = simhash._split(whole, 5000).groupBy("key").count().collect()
    assert len(tasks) > 1000 and max(r["count"] for r in tasks) < 10_000

    def roots(bucket):
        found = components.components(simhash.near_links(df, bucket=bucket))
        return sorted((r.node, r.root) for r in found.collect())

    assert roots(5000) == roots(1 << 40) != []


def test_large_buckets_pass_through(spark):
    """Buckets below, at and above the limit, over batches of any size."""
    rng = np.random.default_rng(9)
    rows = sorted((key, int(x)) for key, n in enumerate([1, 3, 10, 11, 25, 2, 40, 1]) for x in rng.integers(0, 64, n).tolist() for x in [x + 1000 * key])
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "key bigint, fp bigint").coalesce(1).sortWithinPartitions("key", "fp")
    for size in ("3", "7", "100"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = simhash._bucket_links(df, 4, 10).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        sizes = {k: sum(r[0] == k for r in rows) for k in range(8)}
        passed = [(r.key, r.fp) for r in found if r.a is None]
        assert sorted(passed) == [r for r in rows if sizes[r[0]] > 10]
        links = {(r.a // 1000, r.b // 1000) for r in found if r.a is not None}
        assert links <= {(k, k) for k in range(8) if sizes[k] <= 10}
