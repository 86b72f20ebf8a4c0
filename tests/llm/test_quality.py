import numpy as np
from conftest import SF

from foroscope.llm.quality import classify, expectation_maximisation, fit_linear, stage_quality

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def test_accuracies_are_recovered():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.3
    right = (0.95, 0.85, 0.75)
    votes = np.stack([np.where(rng.random(20000) < r, truth, ~truth).astype(int) for r in right], 1)
    votes[rng.random(votes.shape) < 0.2] = -1
    gold = np.where(rng.random(20000) < 0.1, truth, -1).astype(int)
    patterns, which, n = np.unique(np.column_stack([votes, gold]), axis=0, return_inverse=True, return_counts=True)
    post, rate = expectation_maximisation(patterns, n.astype(float), 0.1)
    assert all(abs(rate[k, 1] - r) < 0.03 and abs(1 - rate[k, 0] - r) < 0.03 for k, r in enumerate(right))
    assert ((post[which.ravel()] > 0.5) == truth).mean() > 0.93  # what these votes can tell


def test_linear_scorer():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 500, 30)).astype(np.int32) for _ in range(800)]
    target = np.array([float((r < 8).any()) for r in rows])
    weights, bias = fit_linear(rows, target)
    found = np.array([bias + sum(weights.get(int(f), 0) for f in r) > 0 for r in rows])
    assert (found == (target > 0.5)).mean() > 0.98


def test_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id", "left_semi")
    got = classify(known, labels.filter("doc_id % 4 <> 1")).join(labels, "doc_id").filter("doc_id % 4 = 1").toPandas()
    low = got.p_low > 0.5
    assert (low == (got.quality == 0)).mean() > 0.98
    toxic = got.p_toxic > 0.5
    assert toxic[got.toxic == 1].mean() > 0.6 and toxic[got.toxic == 0].mean() < 0.02


def test_odd_rows(spark, frame):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, None), (None, 1, 1), (4, None, None), (999, 0, 1)], LABELS)
    got = classify(frame(ODD), labels).collect()
    assert len(got) == len(ODD)
    assert all(r.rejected for r in got if r.doc_id in (1, 2, 5))
    assert len(classify(frame(ODD), labels.limit(0)).collect()) == len(ODD)
    assert classify(frame([]), labels).count() == 0


def test_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = stage_quality(spark, docs, SF)
    assert kept.columns == docs.columns and 0.6 * docs.count() < kept.count() < docs.count()
