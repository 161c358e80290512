"""Scorers behind predict_batch_udf: the ONNX path (hand-built model) must
agree with the same weights as a NumPy linear head."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.operators.scoring import LinearModel, onnx_predict_fn, score_udf, with_scores
from lookout.sources.tables import table
from tests.conftest import SF01
from tests.onnx_fixture import linear_model_bytes

ort = pytest.importorskip("onnxruntime")


def test_onnx_model_runs_locally(tmpdir_fresh):
    m = LinearModel.rule(12, 10)
    path = f"{tmpdir_fresh}/m.onnx"
    with open(path, "wb") as f:
        f.write(linear_model_bytes(m.weights, m.bias, [2, 2, 3]))
    x = np.random.default_rng(1).random((5, 2, 2, 3)).astype(np.float32)
    got = onnx_predict_fn(path)()(x)
    want = m.make_predict_fn()()(x)
    assert got.shape == (5, 10) and np.allclose(got, want, atol=1e-5)


def test_onnx_scorer_matches_linear_head(spark, tmpdir_fresh):
    m = LinearModel.rule(64, 10)
    path = f"{tmpdir_fresh}/m.onnx"
    with open(path, "wb") as f:
        f.write(linear_model_bytes(m.weights, m.bias, [64]))
    emb = table(spark, SF01, "embeddings").select("vec_id", "embedding")
    a = with_scores(emb, "embedding", score_udf(onnx_predict_fn(path), [64])).select("vec_id", F.col("y_pred").alias("a"), F.col("scores").alias("sa"))
    b = with_scores(emb, "embedding", score_udf(m.make_predict_fn(), [64])).select("vec_id", F.col("y_pred").alias("b"), F.col("scores").alias("sb"))
    rows = a.join(b, "vec_id").collect()
    assert len(rows) == emb.count()
    assert all(np.allclose(r.sa, r.sb, atol=1e-4) for r in rows)
    assert sum(r.a == r.b for r in rows) >= 0.99 * len(rows)


def test_consumer_cli_with_onnx_model(spark, tmpdir_fresh):
    from lookout.sources.tables import METRICS_SCHEMA, PREDICTION_SCHEMA, read_or_empty
    from lookout.streaming.__main__ import main
    from tests import pngs

    src = f"{tmpdir_fresh}/in"
    rng = np.random.default_rng(5)
    for i in range(5):
        pngs.write(f"{src}/img_{i}.png", rng.integers(0, 256, (12, 10, 3)))
    m = LinearModel.rule(8 * 8 * 3, 10)
    model = f"{tmpdir_fresh}/driver.onnx"
    with open(model, "wb") as f:
        f.write(linear_model_bytes(m.weights, m.bias, [8, 8, 3]))
    out = f"{tmpdir_fresh}/data/output"
    main(["--input", src, "--output", out, "--size", "8", "--model", model, "--available-now", "--csv",
          "--max-files-per-trigger", "2"])
    from lookout.sources.tables import read_part_csvs

    preds = read_part_csvs(spark, out, PREDICTION_SCHEMA)
    assert preds.count() == 5
    metrics = read_part_csvs(spark, f"{tmpdir_fresh}/data/metrics", METRICS_SCHEMA)
    assert sorted(r.num_images for r in metrics.collect()) == [1, 2, 2]
    # same answer as the NumPy head on the same pixels
    from lookout.sources.images import image_features, read_images

    feats = image_features(read_images(spark, src), 8, 8)
    ref = with_scores(feats, "pixels", score_udf(m.make_predict_fn(), [8, 8, 3]))
    want = {r.path.rsplit("/", 1)[-1]: str(r.y_pred) for r in ref.collect()}
    got = {r.image.rsplit("/", 1)[-1]: r.prediction for r in preds.collect()}
    assert got == want
    assert read_or_empty(spark, f"{tmpdir_fresh}/nothing", METRICS_SCHEMA).count() == 0


def test_fused_and_two_step_classification_agree(spark, tmpdir_fresh):
    from lookout.sources.images import read_images
    from lookout.streaming.classify import classify_images
    from tests import pngs

    src = f"{tmpdir_fresh}/in"
    rng = np.random.default_rng(11)
    for i in range(7):
        pngs.write(f"{src}/img_{i}.png", rng.integers(0, 256, (9 + i, 13, 3)))
    with open(f"{src}/broken.png", "wb") as f:
        f.write(b"\x89PNG not really")
    images = read_images(spark, src)
    fused = sorted(tuple(r) for r in classify_images(images, 8, 8).drop("modification_time").collect())
    two = sorted(tuple(r) for r in classify_images(images, 8, 8, fused=False).drop("modification_time").collect())
    assert fused == two and len(fused) == 8
    assert [r for r in fused if r[2] is not None][0][1:] == (None, "undecodable_image")


def test_broadcast_weights_same_predictions(spark):
    emb = table(spark, SF01, "embeddings").select("vec_id", "embedding")
    m = LinearModel.rule(64, 10)
    a = with_scores(emb, "embedding", score_udf(m.make_predict_fn(), [64])).select("vec_id", "y_pred")
    b = with_scores(emb, "embedding", score_udf(m.make_predict_fn(spark), [64])).select("vec_id", "y_pred")
    assert a.exceptAll(b).count() == 0 and b.count() == emb.count()
