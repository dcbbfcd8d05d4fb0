"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

Every document becomes a short vector of statistics of its bytes, words and lines. Random Fourier
features approximate a Gaussian kernel on the standardised vectors. Each partition sums its part of
the normal equations; their total, whose size depends on the number of features alone, gives
the ridge weights. A second part of the labelled rows turns raw scores into probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import fold, in_fold, not_in_fold, ship_package, stored, whole_bytes

#: Raw scores are counted in steps of this width for the calibration.
STEP = 1 / 256
_LETTERS = [b for b in range(256) if b >= 128 or chr(b).isalpha()]
_CLASSES = [
    list(range(97, 123)),
    list(range(65, 91)),
    list(range(48, 58)),
    list(range(128, 256)),
    [32],
    [10],
    list(b".,;:"),
    list(b"!"),
    list(b"?"),
    list(b"|"),
    list(b"#$%&*@^~_=+<>"),
    list(b"()[]{}\"'/-"),
]
N_STATISTICS = len(_CLASSES) + 13


def statistics(text: bytes) -> list[float]:
    """Shares of kinds of bytes, and lengths, variety and repetition of words and lines."""
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n else np.zeros(256)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line]
    count = Counter(words)
    line_count = Counter(lines)
    m, k = max(1, len(words)), max(1, len(lines))
    top = [c for _, c in count.most_common(5)]
    share = seen / max(1, n)
    probabilities = np.fromiter(count.values(), np.float64, len(count)) / m
    return [
        *(float(share[c].sum()) for c in _CLASSES),
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(np.log1p(len(lines))),
        n / m / 10,
        len(words) / k / 100,
        len(count) / m,
        len(count) / m**0.5 / 10,
        (top[0] if top else 0) / m,
        sum(top) / m,
        len(line_count) / k,
        float(-(probabilities * np.log(np.maximum(probabilities, 1e-12))).sum()),
        sum(map(eq, words, words[1:])) / m,
        float(share[_LETTERS].sum()),
    ]


def document_statistics(text_col: str = "text") -> Column:
    """The statistics of a text column as an array of doubles; null is the empty text."""

    @F.arrow_udf("array<double>")
    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return of_batch(whole_bytes(text_col))


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.array(lists.to_pylist(), np.float64).reshape(len(lists), N_STATISTICS)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of the Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.waves + self.phases) * (2 / self.waves.shape[1]) ** 0.5
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores; the raw score decides between equal ones."""
        raw = np.clip(self.raw(x), -1, 2)
        calibrated = np.interp(raw, *self.steps) if self.steps else np.clip(raw, 0, 1)
        return 0.999 * calibrated + 0.001 * (raw + 1) / 3


def _summed(rows: DataFrame, part) -> dict[int, np.ndarray]:
    """Sums over all partitions of the vectors, by number, that ``part`` makes of (statistics, labels).

    Vectors are added within a partition, then position by position; as many numbers reach the
    driver as one partition has.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
                total = one if total is None else [a + b for a, b in zip(total, one)]
        for i, vector in enumerate(total or []):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(vector), i, np.int32)), pa.array(np.arange(len(vector), dtype=np.int32)), pa.array(vector)],
                ["i", "j", "x"],
            )

    sums = rows.select("statistics", "label").mapInArrow(add, "i int, j int, x double")
    table = sums.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    i, j, x = (table.column(k).to_numpy() for k in ("i", "j", "x"))
    return {int(k): x[i == k][np.argsort(j[i == k])] for k in np.unique(i)}


def isotonic(x: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and rising means of blocks of bins."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, n, total):
        blocks.append([a * b, b, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame, features: int = 256, width: float = 4.0, ridge: float = 1e-3, seed: int = 7) -> Model | None:
    """Fit on rows ``statistics, label, calibrates``; rows that calibrate are not fitted on. None without rows."""
    ship_package(rows.sparkSession)
    fitted, others = rows.filter("NOT calibrates"), rows.filter("calibrates")
    moments = _summed(fitted, lambda x, y: [x.sum(axis=0), (x * x).sum(axis=0), np.array([float(len(x))])])
    if not moments:
        return None
    n = moments[2][0]
    mean = moments[0] / n
    scale = np.sqrt(np.maximum(moments[1] / n - mean**2, 1e-8))
    random = np.random.default_rng(seed)
    waves = random.normal(0, 1 / width, (len(mean), features))
    model = Model(mean, scale, waves, random.uniform(0, 2 * np.pi, features), np.zeros(features + 1))

    def normal(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z = model.features(x)
        return [*(z.T @ z), z.T @ y.astype(np.float64)]

    sums = _summed(fitted, normal)
    gram = np.array([sums[i] for i in range(features + 1)])
    penalty = ridge * n * np.eye(features + 1)
    penalty[-1, -1] = 1e-9 * n
    model.weights = np.linalg.solve(gram + penalty, sums[features + 1])

    def binned(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        at = np.floor((np.clip(model.raw(x), -1, 2) + 1) / STEP).astype(np.int64)
        bins = int(3 / STEP) + 1
        return [np.bincount(at, minlength=bins).astype(np.float64), np.bincount(at, y, bins)]

    steps = _summed(others, binned)
    if steps:
        used = steps[0] > 0
        centres = (np.flatnonzero(used) + 0.5) * STEP - 1
        model.steps = isotonic(centres, steps[0][used], steps[1][used])
    return model


def bounded_labels(labels: DataFrame, label: Column, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, label`` of about ``max_rows`` labelled ids, chosen by a hash; an id with several labels has their mean."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), label.cast("double").alias("label")).dropna()
    n = known.count()
    share = min(1.0, max_rows / max(1, n))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * share)
    return known.filter(drawn).groupBy("doc_id").agg(F.avg("label").alias("label"))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    parts: int = 5,
    held: int = 0,
    threshold: float = 0.3,
    max_labels: int = 200_000,
    features: int = 256,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The model learns from labelled documents whose crc32 of the id modulo ``parts`` is not ``held``,
    about ``max_labels`` of them; one of the other folds calibrates. Only the text enters a score.
    Null text counts as empty and is scored like any other. Rows that repeat an id give a row
    each; a null id or label teaches nothing. Without any label the score is 0.5. An empty
    table gives an empty result. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            in_fold(id_col, parts, held).alias("held_out"),
            not_in_fold(id_col, parts, held).alias("learn"),
            fold(id_col, parts).alias("part"),
            document_statistics(text_col).alias("statistics"),
        ),
        "quality-rows",
    )
    known = bounded_labels(labels.filter(not_in_fold(id_col, parts, held)), F.col(label_col), max_labels, id_col)
    taught = rows.filter("learn").join(known, "doc_id").select(
        "statistics", "label", (F.col("part") == (held + parts - 1) % parts).alias("calibrates")
    )
    shared = docs.sparkSession.sparkContext.broadcast(fit(stored(taught, "quality-labels"), features))

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array(model.score(_matrix(batch)) if model else np.full(len(batch), 0.5), pa.float64())

    scored = rows.select("doc_id", "held_out", score("statistics").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
