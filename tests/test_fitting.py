"""The distributed fit against the same steps in NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.functions.arrays import argmax, linear_scores
from lookout.operators.fitting import fit_softmax
from lookout.sources.tables import table
from tests.conftest import SF001


def _numpy_fit(x, y, w, xv, yv, k, steps, rate):
    weights, bias, curve = np.zeros((k, x.shape[1])), np.zeros(k), []

    def probs(a):
        s = a @ weights.T + bias
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    for _ in range(steps + 1):
        p, pv = probs(x), probs(xv)
        train = -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum()
        val = -np.log(pv[np.arange(len(yv)), yv]).mean()
        curve.append((train, val, (pv.argmax(axis=1) == yv).mean()))
        off = p.copy()
        off[np.arange(len(y)), y] -= 1
        off *= w[:, None] / w.sum()
        weights, bias = weights - rate * off.T @ x, bias - rate * off.sum(axis=0)
    return curve


@pytest.mark.parametrize("few", [0, 8])
def test_losses_equal_numpy(spark, monkeypatch, few):
    monkeypatch.setattr("lookout.operators.fitting.FEW", few)  # with and without the middle level
    emb = table(spark, SF001, "embeddings").withColumn("y", argmax(linear_scores("embedding")))
    rows = emb.withColumn("w", 1.0 + F.col("vec_id") % 3).repartition(5)
    train, val = rows.where("vec_id % 5 > 0"), rows.where("vec_id % 5 = 0")
    fit = fit_softmax(train, val, "embedding", "y", "w", steps=12, rate=4.0)
    t, v = train.collect(), val.collect()
    array = lambda rs: np.array([r.embedding for r in rs], np.float32).astype(np.float64)
    want = _numpy_fit(
        array(t), np.array([r.y for r in t]), np.array([r.w for r in t]), array(v), np.array([r.y for r in v]), 10, 12, 4.0
    )
    got = [(s.train_loss, s.val_loss, s.val_accuracy) for s in fit.curve]
    assert np.allclose(got, want, atol=1e-9)
    assert fit.best == int(np.argmin([s.val_loss for s in fit.curve]))
    share = np.bincount([r.y for r in v]).max() / len(v)
    assert fit.curve[-1].val_accuracy > 2 * share  # far above the largest class
    predict = fit.model.make_predict_fn()()
    assert (predict(array(v)).argmax(axis=1) == np.array([r.y for r in v])).mean() == fit.curve[fit.best].val_accuracy


def test_odd_rows_and_no_validation(spark):
    rows = [([1.0, 0.0], 0, 1.0), ([0.0, 1.0], 1, 1.0), (None, 1, 1.0), ([1.0, 1.0], 12, 1.0), ([1.0, 1.0], None, 1.0)]
    df = spark.createDataFrame(rows, "v array<double>, y int, w double").repartition(3)
    fit = fit_softmax(df, df.limit(0), "v", "y", k=2, steps=3)
    assert fit.best == 3 and fit.curve[0].val_loss is None
    assert fit.curve[0].train_loss == pytest.approx(np.log(2)) and fit.curve[3].train_loss < fit.curve[0].train_loss
    with pytest.raises(ValueError):
        fit_softmax(df.limit(0), df, "v", "y", k=2)
