"""Quality classifier: held-out accuracy, calibration and sums over partitions."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from reelmetrics.llm import quality


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, y, _ in held if y == k] for k in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.95
    assert np.mean([p == y for _, y, p in held]) > 0.93


def test_labels_of_the_held_out_fold_teach_nothing(docs, labels):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (dict(quality.quality_scores(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_partitions_do_not_matter(spark, docs, labels):
    rows = docs.join(labels, "doc_id").select(
        quality.document_statistics().alias("statistics"), F.col("quality").cast("double").alias("label"), (F.col("doc_id") % 4 == 0).alias("calibrates")
    )
    one, many = quality.fit(rows.coalesce(1)), quality.fit(rows.repartition(7))
    assert np.allclose(one.weights, many.weights, atol=1e-6)
    x, y = (np.array(v) for v in zip(*[(r.statistics, r.label) for r in rows.filter("NOT calibrates").collect()]))
    z = one.features(x)
    penalty = 1e-3 * len(x) * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9 * len(x)
    assert np.allclose(one.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    model = quality.Model(np.zeros(5), np.ones(5), rng.normal(0, 1 / 4, (5, 20_000)), rng.uniform(0, 2 * np.pi, 20_000), np.zeros(1))
    x = rng.normal(size=(20, 5))
    z = model.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=-1)
    assert np.abs(z @ z.T - np.exp(-distance / 32)).max() < 0.05


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(1)
    x, n = np.arange(12.0), rng.integers(1, 5, 12).astype(float)
    mean = rng.random(12)
    at, got = quality.isotonic(x, n, n * mean)
    assert (np.diff(got) > 0).all() and (np.diff(at) > 0).all()
    # The least value over later ends of the greatest mean over earlier starts.
    best = [max(min(np.average(mean[a : b + 1], weights=n[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert np.allclose(sorted(set(np.round(best, 9))), np.round(got, 9))


def test_odd_rows_and_no_rows(spark, odd, nothing, labels):
    rows = quality.quality_scores(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(nothing, labels).collect() == []
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, quality int")
    assert {r.score for r in quality.quality_scores(odd, none).collect()} == {0.5}
