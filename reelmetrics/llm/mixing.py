"""Mixing documents to target weights of domains, with soft membership.

A classifier that is learnt from the labelled table gives every document a posterior over the
domains; its tokens count towards each domain by that share. Projected gradient steps then
fit one rate per document, never negative, so that the expected tokens of every domain meet
their targets; what they leave open a projection closes.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import lower_ascii, ship_package, stored, whole_bytes, whole_text
from reelmetrics.llm.quality import N_STATISTICS, bounded_labels, statistics

#: The domains of the labelled table, and the share of tokens that each should have.
TARGETS = {"clean": 0.9, "poor": 0.08, "toxic": 0.02}


def domain_of_labels() -> Column:
    """The number of a domain in ``TARGETS``: toxic before poor before clean; null without a label."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


#: The bounds of a rate: a document that is as likely as any to be of the first domain keeps ``FLOOR`` at least,
#: and none is used more than ``CAP`` times.
FLOOR, CAP = 0.05, 20.0
#: Parts of a Newton step that one pass tries, and the weight of the term that keeps multipliers finite.
SHORTER = 0.5 ** np.arange(10)
SOFT = 1e-9
#: Gradient steps: a momentum and a gradient by domain each.
Steps = tuple[tuple[float, np.ndarray], ...]


# -- the classifier ----------------------------------------------------------------------


@dataclass
class Classifier:
    """Softmax over statistics of a document and the evidence of its words for each domain."""

    domains: int
    evidence: dict[bytes, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, text: bytes) -> np.ndarray:
        found = [self.evidence[w] for w in self.evidence.keys() & set(text.lower().split())]
        words = np.array(found) if found else np.zeros((1, self.domains))
        return np.concatenate([statistics(text), words.sum(axis=0) / 4, words.max(axis=0)])

    def posterior(self, inputs: np.ndarray) -> np.ndarray:
        z = np.clip((inputs - self.mean) / self.scale, -10, 10)
        scores = np.concatenate([z, np.ones((len(z), 1))], axis=1) @ self.weights
        shares = np.exp(scores - scores.max(axis=1, keepdims=True))
        return shares / shares.sum(axis=1, keepdims=True)


def _word_evidence(rows: DataFrame, domains: int, max_words: int, least_docs: int) -> dict[bytes, np.ndarray]:
    """Log odds of the domains for the most telling words, by the documents that have them."""
    sizes = np.array(rows.agg(*[F.count(F.when(F.col("domain") == k, 1)) for k in range(domains)]).first(), float)
    words = F.array_distinct(F.split(lower_ascii(F.col("text")), r"[\x20\x09-\x0D]+"))
    names = [f"n{k}" for k in range(domains)]
    counts = (
        rows.select("domain", F.explode(words).alias("word"))
        .filter("word != ''")
        .groupBy("word")
        .agg(*[F.count(F.when(F.col("domain") == k, 1)).alias(names[k]) for k in range(domains)])
    )
    every = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    odds = [
        F.log(((F.col(n) + 0.5) / (sizes[k] + 1)) / ((every - F.col(n) + 0.5) / (sizes.sum() - sizes[k] + 1)))
        for k, n in enumerate(names)
    ]
    telling = F.greatest(*[F.col(n) * o for n, o in zip(names, odds)])
    top = (
        counts.filter(every >= least_docs)
        .select("word", F.array(*odds).alias("odds"), telling.alias("telling"))
        .orderBy(F.desc("telling"), "word")
        .limit(max_words)
    )
    return {r["word"].encode(): np.clip(np.array(r["odds"]), -6, 6) for r in top.collect()}


def _softmax_fit(x: np.ndarray, y: np.ndarray, domains: int, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Softmax weights by accelerated gradient steps on a bounded sample."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    target = np.eye(domains)[y]
    rate = 2 / (np.linalg.norm(x, 2) ** 2 / len(x) + 2 * ridge)
    weights = ahead = np.zeros((x.shape[1], domains))
    for step in range(steps):
        scores = x @ ahead
        shares = np.exp(scores - scores.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        new = ahead - rate * (x.T @ (shares - target) / len(x) + ridge * ahead)
        ahead, weights = new + step / (step + 3) * (new - weights), new
    return weights


def learn_domains(
    docs: DataFrame,
    labels: DataFrame,
    domains: int,
    domain: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labels: int = 20_000,
    max_words: int = 2000,
    least_docs: int = 8,
) -> Classifier | None:
    """Fit the classifier on about ``max_labels`` labelled documents, whole texts; None without any.

    One half of them, by a hash of the id, finds the telling words, the other fits the weights. Ids
    with contradicting labels, and null ids, are left out.
    """
    ship_package(docs.sparkSession)
    # The bound on the labels bounds what is broadcast and what is collected.
    chosen = bounded_labels(labels, domain, max_labels, id_col).filter("label = floor(label)")
    sample = stored(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(text_col).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("text", F.col("label").cast("int").alias("domain"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0).alias("words")),
        "domain-sample",
    )
    evidence = _word_evidence(sample.filter("words"), domains, max_words, least_docs)
    blank = Classifier(domains, evidence, np.zeros(1), np.ones(1), np.zeros(1))
    shared = docs.sparkSession.sparkContext.broadcast(blank)

    @F.arrow_udf("array<double>")
    def inputs(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.inputs(t.as_py()) for t in texts], pa.list_(pa.float64()))

    table = sample.filter("NOT words").select("domain", inputs(F.col("text").cast("binary")).alias("x")).toArrow()
    if not table.num_rows:
        return None
    x = np.array(table.column("x").to_pylist()).reshape(-1, N_STATISTICS + 2 * domains)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.clip((x - mean) / scale, -10, 10)
    return Classifier(domains, evidence, mean, scale, _softmax_fit(z, table.column("domain").to_numpy(), domains))


def membership(docs: DataFrame, classifier: Classifier | None, domains: int, text_col: str = "text") -> Column:
    """A struct ``p, n_tokens``: the posterior over the domains and the number of words between blanks.

    Without a classifier all domains are equally likely.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def judged(texts: pa.Array) -> pa.Array:
        values, fitted = [t.as_py() for t in texts], shared.value
        p = np.full((len(values), domains), 1 / domains)
        if fitted and values:
            p = fitted.posterior(np.array([fitted.inputs(t) for t in values]))
        columns = [pa.array(list(p), pa.list_(pa.float64())), pa.array([len(t.split()) for t in values], pa.int64())]
        return pa.StructArray.from_arrays(columns, ["p", "n_tokens"])

    # A filter on the result must not make Spark judge every text twice.
    once = F.arrow_udf(judged, "struct<p: array<double>, n_tokens: bigint>").asNondeterministic()
    return once(whole_bytes(text_col))


# -- the rates -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    """Rates lie between 0 and ``cap``, those of documents that may well be of the first domain above ``floor``.

    That is where the first domain has an even share of the posterior or more.
    """

    floor: float = 0.0
    cap: float = np.inf

    def lowest(self, p: np.ndarray) -> np.ndarray:
        return np.where(p[:, 0] * p.shape[1] >= 1 - 1e-9, self.floor, 0.0)

    def apply(self, r: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.minimum(np.maximum(r, self.lowest(p)), self.cap)


FREE = Bounds()


def rates(p: np.ndarray, steps: Steps, bounds: Bounds = FREE) -> np.ndarray:
    """Rates after some gradient steps: they begin at 1 and stay within their bounds.

    A step is the momentum, which carries on the last change, and the gradient by domain.
    """
    now = before = np.ones(len(p))
    for momentum, gradient in steps:
        now, before = bounds.apply(now + momentum * (now - before) - p @ gradient, p), now
    return now


def _summed(rows: DataFrame, domains: int, part) -> np.ndarray:
    """The sum over all partitions of the vector that ``part`` makes of posteriors and tokens."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)
            total = part(p, batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64))
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], ["i", "x"])

    sums = rows.select("p", "n_tokens").mapInArrow(add, "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
    return np.array([x for _, x in sorted(map(tuple, sums.collect()))])


def _last_step(
    rows: DataFrame,
    steps: Steps,
    gram: np.ndarray,
    target: np.ndarray,
    tolerance: float,
    bounds: Bounds = FREE,
    most: int = 60,
) -> tuple[np.ndarray, np.ndarray]:
    """The step m after which rates meet the targets, and the totals that it leads to.

    Among all rates r within their bounds that meet the targets, those nearest to the rates q so far, by the
    sum of n (r - q)^2, are q - p m, cut at the bounds, where m minimises a convex function of one number
    per domain, whose gradient is target - S(r). Newton steps find it: one pass over the documents gives value,
    gradient and curvature after a whole step and shorter ones, and the best of them is taken. A
    term of weight ``SOFT`` keeps m finite where no rates meet the targets, and leads to the closest totals
    then. The search ends where the gradient vanishes, which proves the minimum, or where no
    step makes the value smaller, and gives the best point that it has seen.
    """
    k, scale = len(target), max(target.sum(), np.trace(gram))

    def at(points: np.ndarray) -> np.ndarray:
        """Per point the value without its linear and soft terms, the totals and the curvature."""

        def part(p: np.ndarray, n: np.ndarray) -> np.ndarray:
            q, low, out = rates(p, steps, bounds), bounds.lowest(p), []
            for m in points:
                force = p @ m
                r = bounds.apply(q - force, p)
                inner = n * ((r > low) & (r < bounds.cap))
                value = -(n * ((r - q) ** 2 / 2 + r * force)).sum()
                out += [value, *(n * r) @ p, *((p * inner[:, None]).T @ p).reshape(-1)]
            return np.array(out)

        return _summed(rows, k, part).reshape(-1, 1 + k + k * k) / scale

    metric = gram / scale
    # Only what the posteriors span can be reached.
    reach = metric @ np.linalg.pinv(metric, rcond=1e-12, hermitian=True) @ target / scale
    m, now = np.zeros(k), at(np.zeros((1, k)))[0]
    value = now[0]
    for _ in range(most):
        gradient = reach - now[1 : 1 + k] + SOFT * metric @ m
        if np.abs(gradient).max() <= tolerance * target.sum() / scale:
            break
        curvature = now[1 + k :].reshape(k, k) + SOFT * metric
        points = m - SHORTER[:, None] * (np.linalg.pinv(curvature, rcond=1e-14, hermitian=True) @ gradient)
        found = at(points)
        values = found[:, 0] + points @ reach + SOFT / 2 * ((points @ metric) * points).sum(axis=1)
        best = int(np.argmin(values))
        if not values[best] < value:
            break
        m, value, now = points[best], values[best], found[best]
    return m, now[1 : 1 + k] * scale


def solve_rates(
    rows: DataFrame, weights: np.ndarray, max_steps: int = 40, tolerance: float = 1e-5, bounds: Bounds = FREE
) -> tuple[Steps, np.ndarray]:
    """Steps that lead rows ``p, n_tokens`` to the target weights, and the gap that stays by domain.

    Minimises the squared distance of the expected domain totals S(r) = sum of r n p from the targets
    over rates r within ``bounds``, in the metric of G, the inverse of the sum of n p p'. In that metric and with
    tokens as the weight of a document, the gradient of a rate is p G (S - target), and 1 is the
    step that never overshoots. Momentum speeds the steps up; it begins anew when the distance
    grows. All documents add to the sums in the tasks; one number per domain reaches the driver. The
    target total leaves the first domain with the tokens that it has. Where ``max_steps`` gradient steps do
    not meet the targets, ``_last_step`` goes on, and the better of both ends is taken. The gap is in shares
    of the target total; it stays where no rates within the bounds meet the targets, and is never an error.
    """
    ship_package(rows.sparkSession)
    k = len(weights)
    gram = _summed(rows, k, lambda p, n: ((p * n[:, None]).T @ p).reshape(-1))
    if not gram.any():
        return (), np.zeros(k)
    metric = np.linalg.pinv(gram.reshape(k, k), rcond=1e-12, hermitian=True)

    def totals_after(steps: Steps) -> np.ndarray:
        return _summed(rows, k, lambda p, n: (p * (n * rates(p, steps, bounds))[:, None]).sum(axis=0))

    steps: Steps = ()
    now = before = totals_after(steps)
    target = weights * (now[0] / weights[0])
    distance, run = np.inf, 0
    while len(steps) < max_steps and np.abs(now - target).max() > tolerance * target.sum():
        last, distance = distance, float((now - target) @ metric @ (now - target))
        run = 0 if distance > last else run + 1
        momentum = max(0.0, (run - 2) / (run + 1))
        # Totals of rates that no bound cuts are linear in the rates, so those at the point ahead need no pass.
        ahead = now + momentum * (now - before)
        steps = (*steps, (momentum, metric @ (ahead - target)))
        now, before = totals_after(steps), now
    if np.abs(now - target).max() > tolerance * target.sum():
        last, after = _last_step(rows, steps, gram.reshape(k, k), target, tolerance / 10, bounds)
        if np.abs(after - target).max() < np.abs(now - target).max():
            steps, now = (*steps, (0.0, last)), after
    return steps, (now - target) / max(target.sum(), 1.0)


def fit_rates(
    rows: DataFrame, weights: np.ndarray, max_steps: int = 40, tolerance: float = 1e-5, bounds: Bounds = FREE
) -> Steps:
    """The steps of ``solve_rates``."""
    return solve_rates(rows, weights, max_steps, tolerance, bounds)[0]


@dataclass
class Fit:
    classifier: Classifier | None
    weights: np.ndarray
    steps: Steps
    #: Shares of the target total by domain, by which the totals miss their targets.
    gap: np.ndarray
    #: The rows of the documents with ``p`` and ``n_tokens``, stored.
    rows: DataFrame
    bounds: Bounds

    def rate(self) -> Column:
        """The rate of a row of ``rows``."""
        domains, steps, bounds = len(self.weights), self.steps, self.bounds

        def fitted(p: pa.Array) -> pa.Array:
            return pa.array(rates(p.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains), steps, bounds), pa.float64())

        # A filter on the rate must not make Spark find it twice, in two Python workers for each task.
        return F.arrow_udf(fitted, "double").asNondeterministic()("p")


def fit_mixture(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    targets: Mapping[str, float] | None = None,
    domain: Column | None = None,
    kept: Mapping[str, Column] | None = None,
    bounds: Bounds = Bounds(FLOOR, CAP),
    **limits,
) -> Fit:
    """Learn the domains, judge each document once and fit their rates.

    ``targets`` gives the wanted share of tokens by domain; ``domain`` is the number of a row's
    domain in that order, from the labelled table. ``kept`` names what is stored of a document beside
    ``p`` and ``n_tokens``.
    """
    targets = TARGETS if targets is None else targets
    weights = np.array(list(targets.values())) / sum(targets.values())
    if (weights < 0).any() or weights[0] <= 0:
        raise ValueError("weights are not negative, and the first is positive")
    classifier = learn_domains(
        docs, labels, len(weights), domain_of_labels() if domain is None else domain, id_col, text_col, **limits
    )
    kept = {"doc_id": F.col(f"`{id_col}`")} if kept is None else kept
    judged = docs.select(
        F.struct(*[c.alias(n) for n, c in kept.items()]).alias("kept"), membership(docs, classifier, len(weights), text_col).alias("mix")
    )
    rows = stored(judged.select("kept", "mix.p", "mix.n_tokens"), "membership")
    steps, gap = solve_rates(rows, weights, bounds=bounds)
    if np.abs(gap).max() > 1e-5:
        missed = dict(zip(targets, gap.tolist()))
        warnings.warn(f"no rates from {bounds.floor} to {bounds.cap} meet the targets; those found miss them by {missed}", stacklevel=2)
    return Fit(classifier, weights, steps, gap, rows, bounds)


def mix(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, p, n_tokens, rate``; for the options see ``fit_mixture``.

    ``p`` has the posterior of each domain. A rate is how often a document is expected to be used;
    0 leaves it out. Rates are ``CAP`` at most, and ``FLOOR`` at least for documents that may well be of
    the first domain, so no fit empties that domain.

    Null text counts as empty: it has no tokens, but a rate. Rows that repeat an id are judged by
    their texts; equal texts have equal rates. Null ids and labels teach nothing; without labels all
    domains are equally likely. If targets can't be met within the bounds, rates that come close are found,
    with a warning. An empty table gives an empty result. Other columns are not read.
    """
    fit = fit_mixture(docs, labels, **options)
    return fit.rows.select("kept.doc_id", "p", "n_tokens", fit.rate().alias("rate"))


def mixture(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a rate above 0, with all their columns, ``mix_rate`` and ``mix_domains``.

    Columns of these two names are replaced. Odd rows are treated as in ``mix``. The documents are stored
    once more on the way, with their posteriors.
    """
    names = [c for c in docs.columns if c not in ("mix_rate", "mix_domains")]
    fit = fit_mixture(docs, labels, kept={c: F.col(f"`{c}`") for c in names}, **options)
    mixed = fit.rows.select("kept", "p", fit.rate().alias("mix_rate"))
    return mixed.filter("mix_rate > 0").select("kept.*", "mix_rate", F.col("p").alias("mix_domains"))
