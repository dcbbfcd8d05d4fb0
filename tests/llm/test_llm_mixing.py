"""Mixing: rates against a solver on the driver, and membership against labels."""

from types import SimpleNamespace

import numpy as np
import pytest

from reelmetrics.llm import mixing


def _project(p, n, weights, steps=20_000):
    """Plain projected gradient to the end, in the same metric."""
    gram = (p * n[:, None]).T @ p
    metric = np.linalg.pinv(gram)
    target = weights * ((n @ p)[0] / weights[0])
    r = np.ones(len(p))
    for _ in range(steps):
        r = np.maximum(0, r - p @ (metric @ ((n * r) @ p - target)))
    gap = (n * r) @ p - target
    return target, gap @ metric @ gap


@pytest.mark.parametrize("weights", [(0.9, 0.08, 0.02), (0.3, 0.3, 0.4), (1.0, 0.0, 0.0)])
def test_rates_meet_targets(spark, weights):
    rng = np.random.default_rng(1)
    p = rng.dirichlet((0.6, 0.3, 0.2), 400)
    n = rng.integers(0, 500, 400)
    rows = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n)], "p array<double>, n_tokens bigint").repartition(5)
    weights = np.array(weights)
    steps = mixing.fit_rates(rows, weights, max_steps=60)
    r = mixing.rates(p, steps)
    target, best = _project(p, n.astype(float), weights)
    gap = (n * r) @ p - target
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    assert (r >= 0).all()
    assert gap @ metric @ gap <= best + 1e-3 * (target @ metric @ target)
    if best < 1e-9:
        assert np.abs(gap).max() <= 1e-3 * target.sum()


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == len(texts)
    p, n, r = (np.array([x[k] for x in rows]) for k in ("p", "n_tokens", "rate"))
    assert np.allclose(p.sum(axis=1), 1) and (r >= 0).all()
    assert all(x.n_tokens == len(texts[x.doc_id].encode().split()) for x in rows)
    got = (n * r) @ p
    assert np.abs(got / got.sum() - list(mixing.TARGETS.values())).max() < 0.01
    truth = {x.doc_id: 2 if x.toxic else 1 if x.quality == 0 else 0 for x in labels.collect()}
    assert np.mean([np.argmax(x.p) == truth[x.doc_id] for x in rows if x.doc_id in truth]) > 0.9


def test_odd_rows_and_no_rows(spark, odd, nothing, labels):
    assert mixing.mix(odd, labels).count() == odd.count()
    mixed = mixing.mixture(odd, labels)
    assert mixed.columns == [*odd.columns, "mix_rate", "mix_domains"] and 0 < mixed.count() <= odd.count()
    assert mixing.mix(nothing, labels).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = mixing.mix(odd, none).collect()
    assert all(np.allclose(r.p, 1 / 3) for r in rows)
    with pytest.raises(ValueError):
        mixing.mix(odd, labels, targets={"clean": 0.0, "poor": 1.0, "toxic": 0.0})


@pytest.mark.parametrize("sizes", [(0.3, 0.35, 0.35), (0.05, 0.9, 0.05)])
@pytest.mark.parametrize("soft", [2])
def test_soft_and_skewed_posteriors_meet_targets(monkeypatch, sizes, soft):
    """With the parameters of production; 40 gradient steps alone do not."""
    rng = np.random.default_rng(0)
    y = rng.choice(3, 4000, p=sizes)
    z = rng.normal(size=(4000, 3))
    z[np.arange(4000), y] += 6 / soft
    p = np.exp(1.5 * z / soft**0.3)
    p /= p.sum(axis=1, keepdims=True)
    n = rng.integers(1, 800, 4000)
    # Sums on the driver: some fifty passes.
    monkeypatch.setattr(mixing, "ship_package", lambda _: None)
    monkeypatch.setattr(mixing, "_summed", lambda rows, domains, part: part(p, n.astype(float)))
    rows = SimpleNamespace(sparkSession=None)
    weights = np.array(list(mixing.TARGETS.values()))
    r = mixing.rates(p, mixing.fit_rates(rows, weights))
    target = weights * ((n @ p)[0] / weights[0])
    assert np.abs((n * r) @ p - target).max() <= 1e-5 * target.sum()
    assert (r >= 0).all()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    clean = {x.doc_id for x in labels.collect() if not x.toxic and x.quality == 1}
    rates = [x.rate for x in mixing.mix(docs, labels).collect() if x.doc_id in clean]
    assert len(rates) > 100 and min(rates) > 0


def _posteriors(rng, kind, size):
    """Posteriors of many shapes: soft, sharp, skewed, with one domain alone, all alike."""
    if kind == "soft":
        return rng.dirichlet(rng.uniform(0.5, 5, 3), size)
    if kind == "sharp":
        return rng.dirichlet(rng.uniform(0.01, 0.2, 3), size)
    if kind == "skewed":
        return rng.dirichlet((0.02, 5, 0.3), size)
    if kind == "alike":
        return np.tile(rng.dirichlet((1, 1, 1)), (size, 1))
    p = np.full((size, 3), 1e-9)
    p[:, rng.integers(3)] = 1 - 2e-9
    return p


def test_any_posteriors_end_within_bounds(monkeypatch):
    """200 random sets with the parameters of production: no error, the gap is told, no clean document goes."""
    monkeypatch.setattr(mixing, "ship_package", lambda _: None)
    rows, weights = SimpleNamespace(sparkSession=None), np.array(list(mixing.TARGETS.values()))
    bounds, met = mixing.Bounds(mixing.FLOOR, mixing.CAP), 0
    for seed in range(200):
        rng = np.random.default_rng(seed)
        kind = ("soft", "sharp", "skewed", "alike", "alone")[seed % 5]
        p = _posteriors(rng, kind, int(rng.choice([1, 2, 7, 50, 500, 2000])))
        n = rng.integers(0, rng.choice([2, 800, 10**6]), len(p)).astype(float)
        monkeypatch.setattr(mixing, "_summed", lambda rows, domains, part: part(p, n))
        steps, gap = mixing.solve_rates(rows, weights, bounds=bounds)
        r = mixing.rates(p, steps, bounds)
        assert (r >= 0).all() and (r <= mixing.CAP).all() and np.isfinite(r).all()
        assert (r[p[:, 0] >= 1 / 3] >= mixing.FLOOR).all()
        target = weights * ((n @ p)[0] / weights[0])
        assert np.allclose(gap, ((n * r) @ p - target) / max(target.sum(), 1.0), atol=1e-9)
        met += np.abs(gap).max() <= 1e-4
    assert met >= 40


def test_rates_are_found_once(spark, capsys):
    """A filter on the rate takes no second Python worker in each task."""
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    mixed = mixing.mixture(docs, labels)
    mixed.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    assert all(r.mix_rate > 0 for r in mixed.collect())
