"""The pairwise classifier: held-out accuracy, and each odd input."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from foldcat.llm.pairwise_quality import FEATURES, features, fit_pairs, keep_good, labelled_sample, score_documents

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    got = score_documents(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.collect())


def test_sample_is_bounded_and_leaves_out_the_held_out(spark):
    docs, labels = tables(spark)
    x, good = labelled_sample(docs, labels, 20)
    assert x.shape == (40, len(FEATURES)) and good.sum() == 20


def test_odd_documents(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (None, "a b", 3), (4, "x " * 200_000, 4), (4, "x " * 200_000, 4), (6, "a\tb", 5)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1, 5), (4, 0, 5), (6, 1, 6), (None, 1, 7), (2, None, 8)], "doc_id long, quality int, predicted int")
    got = score_documents(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert {r.score for r in got if r.doc_id == 1} == {r.score for r in got if r.doc_id == 2}
    assert keep_good(docs, labels).columns == docs.columns


def test_without_labels_all_scores_are_equal(spark):
    docs, labels = tables(spark)
    got = score_documents(docs, labels.where("quality = 1")).select("score", "predicted").distinct().collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)]
    assert score_documents(docs.limit(0), labels).count() == 0
    assert score_documents(docs, labels.limit(0)).where(F.col("score") != 0.5).count() == 0


def test_weights_order_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    good = x @ np.array([2.0, -1.0, 0.0]) > -1
    model = fit_pairs(x, good)
    s = model.score(x)
    assert ((s >= 0.3) == good).mean() > 0.98
    assert np.corrcoef(model.latent(x), x @ np.array([2.0, -1.0, 0.0]))[0, 1] > 0.98


def test_features_of_nothing():
    assert not features(None).any() and not features(" \n\t").any()


def test_weights_are_those_of_plain_gradient_descent():
    """Bradley-Terry over all pairs of a good and a poor row, one by one, against the Newton steps."""
    rng = np.random.default_rng(2)
    good = np.arange(40) < 22
    x = rng.normal(size=(40, 2)) + np.where(good, 0.7, -0.2)[:, None] * np.array([1.0, -0.5])
    model = fit_pairs(x, good, pairs=60_000)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    w = np.zeros(2)
    for _ in range(3_000):
        gradient = np.zeros(2)
        for a in z[good]:
            diff = a - z[~good]
            gradient -= (diff / (1 + np.exp(diff @ w))[:, None]).sum(0)
        w -= 0.5 * (gradient / (good.sum() * (~good).sum()))
    assert np.allclose(model.weights, w, atol=0.1)
    # The cut parts the labels as well as any other on the scores.
    s = z @ model.weights
    right = lambda cut: (s[good] >= cut).mean() + (s[~good] < cut).mean()
    assert right(model.cut) >= max(right(c) for c in s) - 1e-9
    assert ((model.score(x) >= 0.3) == (s >= model.cut)).all()


def test_a_repeated_id_is_one_row(spark):
    docs = spark.createDataFrame([(1, "good text of one id")] * 300 + [(2, "poor")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    x, good = labelled_sample(docs, labels, 20)
    assert x.shape[0] == 2 and good.sum() == 1
