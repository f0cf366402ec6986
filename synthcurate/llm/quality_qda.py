"""Quality classifier: regularised quadratic discriminant analysis.

Statistics of a whole text are transformed (square roots of shares, logarithms
of sizes). One Spark aggregation gathers count, sum and sum of products for
each class; the driver only sees these few hundred numbers. Class covariances
are shrunk towards the pooled covariance and towards a scaled identity, their
Cholesky factors are inverted once and travel with the scoring function. The
score is a sigmoid of the compressed difference of the two log densities, its
slope and offset fitted on a histogram of the training rows.

Defined results: NULL and empty texts are scored like any text of no words.
NULL labels are not used, repeated labels count each time. If only one class is
labelled its label is every score; without labels every score is 1.0 (nothing
is known that could be rejected). Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_udf, texts

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
FEATURES = 13


def _share(part: float, whole: float) -> float:
    return (part / whole) ** 0.5 if whole else 0.0


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text."""
    n = len(text)
    words = text.split()
    lower = [w.lower() for w in words]
    lines = [x for x in text.split(b"\n") if x.strip()]
    cut = lambda chars: n - len(text.translate(None, chars))
    high = sum(map(len, words))
    repeats = sum(map(bytes.__eq__, lower[1:], lower))
    return [
        float(np.log1p(len(words))),
        float(np.log1p(high / len(words))) if words else 0.0,
        _share(cut(UPPER), n),
        _share(cut(DIGITS), n),
        _share(cut(SYMBOLS), n),
        _share(cut(b"!?"), n),
        _share(cut(b".,;:"), n),
        _share(len(set(lower)), len(words)),
        _share(repeats, len(words)),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(n - len(text.decode("utf-8", "replace")), n),
        float(np.log1p(n / len(lines))) if lines else 0.0,
        _share(sum(1 for w in words if not w.isalpha() and w.isascii()), len(words)),
    ]


def features(text: Column) -> Column:
    return text_udf(statistics, pa.list_(pa.float64()), "array<double>")(text)


@dataclass(frozen=True)
class Model:
    """``only`` is the score of every text where no boundary could be fitted."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()  # inverted Cholesky factors
    logdets: tuple[float, ...] = ()
    slope: float = 1.0
    offset: float = 0.0
    only: float | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, compressed by asinh."""
        z = (x - self.centre) / self.scale
        logs = [-0.5 * np.square((z - m) @ f.T).sum(1) - d for m, f, d in zip(self.means, self.factors, self.logdets)]
        return np.arcsinh(logs[1] - logs[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        return np.round(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -500, 500))), 9)


def _matrix(array: pa.Array) -> np.ndarray:
    return np.asarray(array.flatten(), dtype=float).reshape(len(array), FEATURES)


def _moments(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x, y = _matrix(batch.column(0)), np.asarray(batch.column(1))
        for label in np.unique(y):
            part = np.c_[np.ones(int((y == label).sum())), x[y == label]]
            sums[int(label)] = sums.get(int(label), 0) + part.T @ part
    for label, total in sums.items():
        flat = total.ravel()
        yield pa.record_batch({"label": pa.array([label] * len(flat), pa.int32()), "at": pa.array(range(len(flat)), pa.int32()), "value": flat})


def fit(labelled: DataFrame, features_col: str, label_col: str, pooled: float = 0.2, identity: float = 0.05) -> Model:
    """Fit on all rows whose label is 0 or 1. ``pooled`` and ``identity`` are
    the shares of the pooled covariance and of the scaled identity."""
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(features_col), F.col(label_col).cast("int"))
    sums = rows.mapInArrow(_moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    size = FEATURES + 1
    totals = {k: np.zeros(size * size) for k in (0, 1)}
    for label, at, value in sums.collect():  # at most 2 x 14 x 14 rows
        totals[label][at] = value
    grams = [totals[k].reshape(size, size) for k in (0, 1)]
    counts = [g[0, 0] for g in grams]
    if min(counts) < 2:
        only = 1.0 if not sum(counts) else float(counts[1] > counts[0])
        return Model(np.zeros(FEATURES), np.ones(FEATURES), only=only)
    both = grams[0] + grams[1]
    centre = both[0, 1:] / both[0, 0]
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / both[0, 0] - centre**2, 0))
    scale[scale < 1e-9] = 1.0
    means = [(g[0, 1:] / n - centre) / scale for g, n in zip(grams, counts)]
    covs = []
    for g, n, m in zip(grams, counts, means):
        second = g[1:, 1:] / n - np.outer(centre, g[0, 1:] / n) - np.outer(g[0, 1:] / n, centre) + np.outer(centre, centre)
        covs.append(second / np.outer(scale, scale) - np.outer(m, m))
    mixed = (counts[0] * covs[0] + counts[1] * covs[1]) / sum(counts)
    factors, logdets = [], []
    for c in covs:
        shrunk = (1 - pooled - identity) * c + pooled * mixed + identity * (np.trace(mixed) / FEATURES + 1e-6) * np.eye(FEATURES)
        lower = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        factors.append(np.linalg.inv(lower))
        logdets.append(float(np.log(np.diag(lower)).sum()))
    model = Model(centre, scale, tuple(means), tuple(factors), tuple(logdets))
    return _calibrated(model, rows, features_col, label_col)


def _calibrated(model: Model, rows: DataFrame, features_col: str, label_col: str, width: float = 0.05) -> Model:
    """Slope and offset by Newton steps on a histogram of the margins. asinh
    keeps margins below 800 in absolute value, so the bins are bounded."""

    @F.arrow_udf("int")
    def bin_of(x: pa.Array) -> pa.Array:
        return pa.array(np.round(model.margin(_matrix(x)) / width).astype(np.int32))

    bins = rows.select(bin_of(features_col).alias("bin"), label_col).groupBy("bin").agg(F.count("*").alias("n"), F.sum(label_col).alias("ones"))
    seen = np.array([tuple(r) for r in bins.collect()], dtype=float)
    u, n, ones = seen[:, 0] * width, seen[:, 1], seen[:, 2]
    design, theta = np.c_[u, np.ones(len(u))], np.array([1.0, 0.0])
    ridge = np.diag([0.1, 0.1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (ones - n * p) - ridge @ (theta - [1.0, 0.0])
        theta = theta + np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, gradient)
    if not (np.isfinite(theta).all() and theta[0] > 0):
        theta = np.array([1.0, 0.0])
    return Model(model.centre, model.scale, model.means, model.factors, model.logdets, float(theta[0]), float(theta[1]))


def score_features(model: Model, values: Column) -> Column:
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(x)))

    return score(values)


def score_text(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        rows = [statistics(b or b"") for part in texts(x) for b in part]
        return pa.array(model.score(np.array(rows).reshape(len(rows), FEATURES)))

    return score(text)


def labelled_rows(docs: DataFrame, labels: DataFrame, text_features: Column) -> DataFrame:
    """Features and labels of the labelled documents. Only ids, labels and
    features are shuffled."""
    right = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_label")).filter(F.col("_label").isin(0, 1))
    left = docs.select("doc_id", text_features.alias("_features"))
    return left.join(right, left["doc_id"] == right["_labelled"]).select("_features", "_label")


def keep_good(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """The rows whose score is at least ``least``, with their columns as they were."""
    name = fresh(docs, "_score")
    return docs.withColumn(name, score_text(model, F.col("text"))).filter(F.col(name) >= least).drop(name)
