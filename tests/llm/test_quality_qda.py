import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from synthcurate.llm import quality_qda as q
from synthcurate.llm.queries import QUERIES


def labelled(spark, rows):
    return spark.createDataFrame(rows, "f array<double>, y int")


def test_moments_and_scores_match_plain_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (60, q.FEATURES)), rng.normal(1.5, 2, (80, q.FEATURES))])
    y = np.r_[np.zeros(60, int), np.ones(80, int)]
    model = q.fit(labelled(spark, [(r.tolist(), int(k)) for r, k in zip(x, y)]).repartition(3), "f", "y", 0.2, 0.05)
    centre, scale = x.mean(0), x.std(0)
    z = (x - centre) / scale
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    mixed = (60 * covs[0] + 80 * covs[1]) / 140
    logs = []
    for k in (0, 1):
        c = 0.75 * covs[k] + 0.2 * mixed + 0.05 * (np.trace(mixed) / q.FEATURES + 1e-6) * np.eye(q.FEATURES)
        d = z - z[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(model.margin(x), np.arcsinh(logs[1] - logs[0]))
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95


@pytest.mark.parametrize("rows, score", [([], 1.0), ([([0.0] * q.FEATURES, 1)] * 3, 1.0), ([([0.0] * q.FEATURES, 0)] * 3, 0.0)])
def test_without_two_classes(spark, rows, score):
    model = q.fit(labelled(spark, rows), "f", "y")
    assert model.score(np.zeros((2, q.FEATURES))).tolist() == [score, score]


def test_constant_features_and_null_labels(spark):
    rows = [([1.0] * q.FEATURES, 0)] * 3 + [([2.0] + [1.0] * (q.FEATURES - 1), 1)] * 3 + [([9.0] * q.FEATURES, None)]
    model = q.fit(labelled(spark, rows), "f", "y")
    assert np.isfinite(model.score(np.ones((1, q.FEATURES)))).all()


def test_odd_rows_pass_through(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, None), (3, 0, 0), (10, 0, 1), (8, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = q.fit(q.labelled_rows(odd_docs, labels, q.features(F.col("text"))), "_features", "_label")
    scored = odd_docs.select(q.score_text(model, F.col("text")).alias("s")).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.s <= 1 for r in scored)
    kept = q.keep_good(odd_docs, model, least=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert q.keep_good(no_docs, model).count() == 0


def test_held_out_accuracy(spark):
    scores = QUERIES["op1_quality_classifier"](spark, f"{DATA}/sf0.01")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    rows = scores.filter("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
