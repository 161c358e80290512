"""Evaluation tables against hand-computed values (zero support, zero
predictions, macro vs weighted means, clipped cross-entropy)."""

import math

import pytest

from lookout.operators import evaluation as E

# y_true, y_pred
PAIRS = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]


def _scored(spark, probs=None):
    rows = [(i, t, p, probs[i] if probs else [0.0] * 10) for i, (t, p) in enumerate(PAIRS)]
    return spark.createDataFrame(rows, "vec_id long, y_true int, y_pred int, scores array<float>")


def test_classification_report_by_hand(spark):
    rep = {r.label.split(":")[0]: r for r in E.classification_report(_scored(spark)).collect()}
    assert (rep["c0"].precision, rep["c0"].recall, rep["c0"].f1_score, rep["c0"].support) == (0.5, 0.5, 0.5, 2)
    assert rep["c1"].precision == pytest.approx(2 / 3, abs=1e-6) and rep["c1"].recall == 1.0
    assert rep["c1"].f1_score == pytest.approx(0.8, abs=1e-6)
    assert (rep["c2"].precision, rep["c2"].recall, rep["c2"].f1_score, rep["c2"].support) == (0.0, 0.0, 0.0, 1)
    assert (rep["c7"].precision, rep["c7"].support) == (0.0, 0)  # no support, no prediction
    acc = rep["accuracy"]
    assert acc.precision is None and acc.f1_score == 0.6 and acc.support == 5
    macro, weighted = rep["macro avg"], rep["weighted avg"]
    assert macro.precision == pytest.approx((0.5 + 2 / 3) / 10, abs=1e-6)
    assert macro.recall == pytest.approx(0.15, abs=1e-6) and macro.f1_score == pytest.approx(0.13, abs=1e-6)
    assert weighted.precision == pytest.approx((0.5 * 2 + 2 / 3 * 2) / 5, abs=1e-6)
    assert weighted.recall == pytest.approx(0.6, abs=1e-6) and weighted.f1_score == pytest.approx(0.52, abs=1e-6)


def test_confusion_forms_agree(spark):
    s = _scored(spark)
    long = {(r.y_true, r.y_pred): r.n for r in E.confusion_long(s).collect()}
    wide = {r.y_true: r for r in E.confusion_wide(s).collect()}
    assert long[(0, 0)] == 1 and long[(0, 1)] == 1 and long[(1, 1)] == 2 and long[(2, 0)] == 1
    assert sum(long.values()) == 5 and len(long) == 100
    for (t, p), n in long.items():
        assert getattr(wide[t], f"p{p}") == n


def test_loss_accuracy_by_hand(spark):
    probs = []
    for t, _ in PAIRS:
        p = [0.0] * 10
        p[t] = 0.8 if t != 2 else 0.0  # class-2 row: true class prob 0 -> clipped at 1e-7
        p[(t + 1) % 10] = 1.0 - p[t]
        probs.append(p)
    out = E.loss_accuracy(_scored(spark, probs), from_logits=False).first()
    p_true = [0.8, 0.8, 0.8, 0.8, 1e-7]
    want = sum(-math.log(p) for p in p_true) / 5
    assert out.loss == pytest.approx(round(want, 6), abs=1e-6)
    assert out.accuracy == 0.6 and out.n_rows == 5


def test_labels_outside_the_dimension_are_kept(spark):
    s = spark.createDataFrame([(0, 0), (0, 0), (0, 10), (0, 10), (12, 0), (None, 1)], "y_true int, y_pred int")
    rep = {r.label: r for r in E.classification_report(s).collect()}
    c0 = next(r for name, r in rep.items() if name.startswith("c0"))
    assert (c0.support, c0.recall) == (4, 0.5) and c0.precision == pytest.approx(2 / 3, abs=1e-6)
    assert rep["accuracy"].f1_score == 0.4 and rep["accuracy"].support == 5
    assert rep["12"].support == 1 and rep["10"].support == 0
    long = {(r.y_true, r.y_pred): r.n for r in E.confusion_long(s, 12).collect()}
    assert len(long) == 13 * 13 and long[0, 10] == 2 and long[12, 0] == 1 and long[11, 11] == 0
    wide = E.confusion_wide(s, 12)
    assert wide.columns == ["y_true", *[f"p{i}" for i in range(12)]]
    assert {r.y_true for r in wide.collect()} == set(range(13))


@pytest.mark.parametrize("learnable", [False, True])
def test_fitted_report_against_brute_force_and_chance(spark, tmp_path, learnable):
    """The small given table only has the measures compared (accuracy there is
    0.07, its largest class 0.13); accuracy must be far above chance where the
    labels follow from the vectors."""
    from lookout.plans.q_streaming import scored_validation
    from tests.conftest import SF001

    sf = SF001
    if learnable:
        sf = str(tmp_path)
        vector = lambda i: [float(i % 10 == j) + (i * (j + 3) % 7) / 20 for j in range(64)]
        made = spark.createDataFrame([(i, i % 10, vector(i)) for i in range(400)], "vec_id long, label int, embedding array<float>")
        made.write.parquet(f"{sf}/embeddings.parquet")
    scored = scored_validation(spark, sf).checkpoint()
    rows = [(r.y_true, r.y_pred) for r in scored.collect()]
    n = len(rows)
    report = {r.label: r for r in E.classification_report(scored).collect()}
    for k in range(10):
        tp, true, said = (sum(map(f, rows)) for f in (lambda r: r == (k, k), lambda r: r[0] == k, lambda r: r[1] == k))
        got = next(r for name, r in report.items() if name.startswith(f"c{k}"))
        precision, recall = tp / said if said else 0.0, tp / true if true else 0.0
        f1 = 2 * precision * recall / (precision + recall) if tp else 0.0
        assert (got.precision, got.recall, got.f1_score) == pytest.approx((precision, recall, f1), abs=1e-6)
        assert got.support == true
    accuracy = sum(t == p for t, p in rows) / n
    assert report["accuracy"].f1_score == pytest.approx(accuracy, abs=1e-6)
    if learnable:
        chance = max(sum(t == k for t, _ in rows) for k in range(10)) / n
        assert accuracy > 5 * chance
