"""Model scoring (D2-D6, W13): pixel vectors -> class scores -> class.

A model is a factory ``make_predict_fn() -> predict(x)`` built once per
Python worker. Static tables score through
``pyspark.ml.functions.predict_batch_udf`` (rows arrive as Arrow batches,
reshaped to the model's input tensor); the image stream calls the same
factory from its fused resize+score pass (``cached_predict``). The scorer
is pluggable: the rule-defined linear head (default; SQL-checkable), any
weight matrix, an ONNX file (when ``onnxruntime`` is present), or a fitted
``pyspark.ml`` model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.functions.arrays import argmax
from lookout.session import prepare, prepare_active

SCORES_TYPE = T.ArrayType(T.FloatType())

# Models built in this Python worker, by key: a worker is reused across
# tasks, so each model is loaded once per worker, not once per task.
_MODELS: dict = {}
KEPT_MODELS = 4


def cached_predict(key: str, make_predict_fn):
    """The ``predict`` function of ``make_predict_fn()``, built once per
    Python worker process."""
    fn = _MODELS.get(key)
    if fn is None:
        while len(_MODELS) >= KEPT_MODELS:  # oldest first: workers outlive queries
            _MODELS.pop(next(iter(_MODELS)))
        fn = _MODELS[key] = make_predict_fn()
    return fn


class LinearModel:
    """Dense + softmax head as a weight matrix (K x D) and bias (K)."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights = np.asarray(weights, dtype=np.float64)
        self.bias = np.asarray(bias, dtype=np.float64)

    @classmethod
    def rule(cls, n_features: int, k: int = 10) -> "LinearModel":
        """The deterministic stand-in model:
        ``w[c][i] = ((7c + 3i) % 11 - 5) / 10``, ``b[c] = c / 100``."""
        c = np.arange(k)[:, None]
        i = np.arange(n_features)[None, :]
        return cls(((7 * c + 3 * i) % 11 - 5) / 10.0, np.arange(k) / 100.0)

    def make_predict_fn(self, spark=None) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
        """The returned factory runs once per Python worker. Small
        weights travel in the closure; with ``spark`` they are shipped as a
        broadcast variable instead (fetched once per executor, only a handle
        in every task's closure) -- the way for large weight matrices."""
        if spark is not None:
            shipped = spark.sparkContext.broadcast((self.weights, self.bias))

            def make():
                weights, bias = shipped.value

                def predict(x: np.ndarray) -> np.ndarray:
                    return x.reshape(x.shape[0], -1).astype(np.float64) @ weights.T + bias

                return predict

            return make
        weights, bias = self.weights, self.bias

        def make():
            def predict(x: np.ndarray) -> np.ndarray:
                flat = x.reshape(x.shape[0], -1).astype(np.float64)
                return flat @ weights.T + bias

            return predict

        return make


def onnx_predict_fn(model_path: str) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Factory for an ONNX file (opened once per worker). The file must be
    reachable from executors: a shared path, or shipped with
    ``SparkContext.addFile`` and given here by name."""

    def make():
        import os

        import onnxruntime as ort
        from pyspark import SparkFiles

        path = model_path if os.path.exists(model_path) else SparkFiles.get(os.path.basename(model_path))
        session = ort.InferenceSession(path, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name

        def predict(x: np.ndarray) -> np.ndarray:
            return session.run(None, {name: x.astype(np.float32)})[0]

        return predict

    return make


def score_udf(make_predict_fn, input_shape: Sequence[int], batch_size: int = 64):
    """Arrow-batched scoring UDF; ``input_shape`` reshapes each flat
    vector to the model's tensor (e.g. ``[64, 64, 3]``)."""
    from pyspark.ml.functions import predict_batch_udf

    prepare_active()
    return predict_batch_udf(
        make_predict_fn,
        return_type=SCORES_TYPE,
        batch_size=batch_size,
        input_tensor_shapes=[list(input_shape)],
    )


def with_scores(df: DataFrame, vec_col: str, udf, scores_col: str = "scores") -> DataFrame:
    """Scores and the predicted class (first argmax) for every row."""
    prepare(df.sparkSession)
    scored = df.withColumn(scores_col, udf(F.col(vec_col)))
    return scored.withColumn("y_pred", argmax(scores_col))


def prediction_text(y_pred: Column) -> Column:
    """class index as text, the prediction table's format."""
    return y_pred.cast("string")


def fit_logistic(train: DataFrame, vec_col: str, label_col: str = "label", weight_col: str | None = None, max_iter: int = 50):
    """Fit a multinomial logistic regression (the Dense+softmax head) on
    the feature table, with optional class weights."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = train.withColumn("features", array_to_vector(F.col(vec_col))).withColumn(
        "label_d", F.col(label_col).cast("double")
    )
    lr = LogisticRegression(
        featuresCol="features", labelCol="label_d", family="multinomial", maxIter=max_iter, regParam=1e-3
    )
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    return lr.fit(data)


def apply_logistic(model, df: DataFrame, vec_col: str) -> DataFrame:
    """Score with a fitted model: ``y_pred`` (INT) and probability scores."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    out = model.transform(df.withColumn("features", array_to_vector(F.col(vec_col))))
    return out.withColumn("y_pred", F.col("prediction").cast("int")).withColumn(
        "scores", vector_to_array("probability", "float32")
    ).drop("features", "rawPrediction", "probability", "prediction")
