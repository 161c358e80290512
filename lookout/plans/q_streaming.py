"""Registered queries: the streaming path (T1-T4, S9, S10, S13) and batch
scoring (D2-D4, D6, W13). Streams run with ``availableNow`` so they drain
their input and stop; the result is read back from what the sink wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from lookout.functions.arrays import argmax, linear_scores
from lookout.operators import dataset as D
from lookout.operators import evaluation as E
from lookout.operators import scoring as SC
from lookout.operators.fitting import fit_softmax
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register
from lookout.plans.sqlfrag import linear_sql
from lookout.plans.q_images import ID_FROM_PATH, RGB_LEN, SIDE, export_features
from lookout.session import work_dir
from lookout.sources.tables import METRICS_SCHEMA, PREDICTION_SCHEMA, read_or_empty, read_part_csvs, table
from lookout.streaming.sink import BatchSink, write_partition
from lookout.streaming import classify as C

W = S.with_ctes
EVENTS_PER_TRIGGER = 1
IMAGES_PER_TRIGGER = 1000


def _event_stream(spark, sf):
    """``events`` replayed as a file stream (S13): the driver folder filtered
    to the events file, at most N files per micro-batch."""
    schema = table(spark, sf, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", EVENTS_PER_TRIGGER)
        .parquet(sf)
    )


def _as_predictions(ev):
    # The stand-in scorer for event rows (same rule as the ``pred`` table).
    return ev.select(
        F.concat(
            F.lit(S.URI_PREFIX), F.col("event_type"), F.lit("+"), F.col("event_id").cast("string"), F.lit(".jpg")
        ).alias("image"),
        (F.col("user_id") % 11).cast("string").alias("prediction"),
        F.col("ts").alias("modification_time"),
    )


def _run_event_stream(spark, sf):
    base = work_dir(spark, "stream")
    out, met, ckpt = f"{base}/predictions", f"{base}/metrics", f"{base}/checkpoint"
    q = C.start_table_stream(_as_predictions(_event_stream(spark, sf)), out, met, ckpt)
    q.awaitTermination()
    return out, met


@register("stream_predictions", W("SELECT image, prediction FROM pred", S.PRED_SQL))
def stream_predictions(spark, sf):
    """Stream -> idempotent per-batch sink -> read back."""
    out, _ = _run_event_stream(spark, sf)
    return read_or_empty(spark, out, PREDICTION_SCHEMA).select("image", "prediction")


@register(
    "stream_batch_metrics",
    "SELECT CAST(0 AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS num_images FROM events",
)
def stream_batch_metrics(spark, sf):
    """One timing row per micro-batch (durations vary run to run,
    so the check is on batch ids and image counts)."""
    _, met = _run_event_stream(spark, sf)
    return read_or_empty(spark, met, METRICS_SCHEMA).select("batch_id", "num_images")


TWO_RUNS_SQL = W(
    """SELECT image, prediction, CAST(2 AS BIGINT) AS copies FROM pred""",
    S.PRED_SQL,
)


@register("stream_two_runs", TWO_RUNS_SQL)
def stream_two_runs(spark, sf):
    """Two checkpoints over one output folder, several micro-batches
    each, and a replayed batch: every run keeps its rows once."""
    base = work_dir(spark, "two-runs")
    src, out, met = f"{base}/source", f"{base}/predictions", f"{base}/metrics"
    rows = _as_predictions(table(spark, sf, "events"))
    rows.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    for run in ("a", "b"):
        C.start_table_stream(stream, out, met, f"{base}/checkpoint-{run}").awaitTermination()
    # Batch 0 of the second run once more, as after a crash before its commit.
    sink = BatchSink(out, met, checkpoint=f"{base}/checkpoint-b")
    first = spark.read.parquet(out).where((F.col("run_id") == sink.run(spark)) & (F.col("batch_id") == 0))
    sink(first.select("image", "prediction", "modification_time").checkpoint(), 0)
    preds = read_or_empty(spark, out, PREDICTION_SCHEMA)
    return preds.groupBy("image", "prediction").agg(F.count(F.lit(1)).alias("copies"))


@register(
    "stream_class_counts",
    W(
        f"""SELECT TRY_CAST(prediction AS INTEGER) AS class_id,
       {Q.class_name('TRY_CAST(prediction AS INTEGER)')} AS class_name, CAST(count(*) AS BIGINT) AS n_images
FROM pred GROUP BY 1""",
        S.PRED_SQL,
    ),
)
def stream_class_counts(spark, sf):
    """T4: running class counts refreshed into a table."""
    base = work_dir(spark, "live-counts")
    q = C.start_live_class_counts(_as_predictions(_event_stream(spark, sf)), f"{base}/table", f"{base}/checkpoint")
    q.awaitTermination()
    return C.read_live_table(spark, f"{base}/table")


def _rgb_linear_sql() -> str:
    rgb = f"list_transform(range({RGB_LEN}), lambda i: CAST(pixels[i // 3 + 1] AS DOUBLE) / 255.0)"
    return W(
        f"""SELECT vec_id, CAST(list_position(sc, list_max(sc)) - 1 AS VARCHAR) AS prediction
FROM (SELECT vec_id, {linear_sql('rgb')} AS sc FROM (SELECT vec_id, {rgb} AS rgb FROM feat))""",
        S.FEAT_SQL,
    )


@register("stream_image_predictions", _rgb_linear_sql())
def stream_image_predictions(spark, sf):
    """A folder of PNG files streamed through decode,
    resize, Arrow-batched scoring and the idempotent sink."""
    src = export_features(spark, sf)
    base = work_dir(spark, "image-stream")
    with C.many_small_files(spark):
        q = C.start_image_classifier(
            spark,
            src,
            f"{base}/predictions",
            f"{base}/metrics",
            f"{base}/checkpoint",
            height=SIDE,
            width=SIDE,
            max_files_per_trigger=IMAGES_PER_TRIGGER,
        )
        q.awaitTermination()
        preds = read_or_empty(spark, f"{base}/predictions", PREDICTION_SCHEMA)
    return preds.select(F.regexp_extract("image", ID_FROM_PATH, 1).cast("bigint").alias("vec_id"), "prediction")


@register(
    "batch_scoring",
    f"""SELECT vec_id, CAST(list_position(sc, list_max(sc)) - 1 AS INTEGER) AS prediction
FROM (SELECT vec_id, {linear_sql('embedding')} AS sc FROM embeddings)""",
)
def batch_scoring(spark, sf):
    """A static table through ``predict_batch_udf`` (64-row
    batches; the weights ride in the model factory's closure)."""
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    udf = SC.score_udf(SC.LinearModel.rule(64).make_predict_fn(), [64], batch_size=64)
    scored = SC.with_scores(emb, "embedding", udf)
    return scored.select("vec_id", F.col("y_pred").alias("prediction"))


def _fit_sql() -> str:
    from lookout.plans.q_dataset import _strat_sql

    val = f"val AS (SELECT label FROM ({_strat_sql('vec_id', 'label', 'embeddings')}) WHERE split = 'val')"
    return W(
        """SELECT c.class_name AS label, CAST(count(v.label) AS BIGINT) AS support, true AS in_range
FROM classes c LEFT JOIN val v ON v.label = c.class_id GROUP BY c.class_name
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT CAST(count(*) AS BIGINT) FROM val), true""",
        Q.classes_cte(),
        val,
    )


def scored_validation(spark, sf):
    """The fitted model's predictions on the validation split."""
    emb = table(spark, sf, "embeddings")
    data = D.stratified_split(emb, "vec_id", "label", keep_all=True)
    train = data.where(F.col("split") == "train")
    weights = D.class_weights(train)
    model = SC.fit_logistic(D.with_weights(train, weights), "embedding", "label", "weight", max_iter=30)
    val = SC.apply_logistic(model, data.where(F.col("split") == "val"), "embedding")
    return val.select("vec_id", F.col("label").alias("y_true"), "y_pred", "scores")


@register("fit_and_score", _fit_sql())
def fit_and_score(spark, sf):
    """D6 + A11/A12: fit a weighted multinomial logistic regression on the
    train split of the feature table, score the validation split and report.
    Fitted weights are no SQL quantity: the check is on the support of every
    class and on measures within 0..1; the tests compare the measures with a
    brute-force report and the accuracy with chance."""
    measures = [F.coalesce(F.col(c), F.lit(0.0)).between(0, 1) for c in ("precision", "recall", "f1_score")]
    return E.classification_report(scored_validation(spark, sf)).select(
        "label", "support", (measures[0] & measures[1] & measures[2]).alias("in_range")
    )


FIT_STEPS, FIT_RATE = 4, 4.0
RULE_CLASS = f"(list_position({linear_sql('embedding')}, list_max({linear_sql('embedding')})) - 1)"


def _curve_sql() -> str:
    """Gradient descent on the softmax loss, one group of CTEs per step."""
    from lookout.plans.q_dataset import _strat_sql

    sql = f"""WITH t AS MATERIALIZED (SELECT vec_id, CAST({RULE_CLASS} AS INTEGER) AS label, embedding FROM embeddings),
r AS MATERIALIZED (SELECT vec_id, label AS y, split = 'val' AS val,
    list_transform(embedding, lambda x: CAST(x AS DOUBLE)) || [1.0::DOUBLE] AS x
  FROM t JOIN ({_strat_sql("vec_id", "label", "t")}) USING (vec_id, label)),
k AS MATERIALIZED (SELECT *, CASE WHEN val THEN 1.0 ELSE
    sum(n) OVER () / (count(*) OVER () * n) END AS w FROM (SELECT y, val, count(*)::DOUBLE AS n FROM r WHERE NOT val GROUP BY y, val)),
d AS MATERIALIZED (SELECT r.*, coalesce(k.w, 1.0) AS w FROM r LEFT JOIN k USING (y, val)),
f AS MATERIALIZED (SELECT vec_id, y, val, w, j, x[j] AS v FROM d, (SELECT unnest(range(1, 66)) AS j)),
m0 AS MATERIALIZED (SELECT c, j, 0.0::DOUBLE AS b FROM (SELECT unnest(range(10)) AS c), (SELECT unnest(range(1, 66)) AS j))"""
    for i in range(FIT_STEPS + 1):
        sql += f""",
s{i} AS MATERIALIZED (SELECT vec_id, y, val, w, c, sum(v * b) AS s FROM f JOIN m{i} USING (j) GROUP BY ALL),
p{i} AS MATERIALIZED (SELECT *, exp(s - max(s) OVER q) / sum(exp(s)) OVER q * exp(max(s) OVER q) AS p,
    row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) = 1 AS top FROM s{i} WINDOW q AS (PARTITION BY vec_id)),
l{i} AS (SELECT {i} AS step, sum(CASE WHEN NOT val THEN -w * ln(p) END) / sum(CASE WHEN NOT val THEN w END) AS train_loss,
    avg(CASE WHEN val THEN -ln(p) END) AS val_loss, avg(CASE WHEN val THEN CAST(top AS INTEGER) END) AS val_accuracy
  FROM p{i} WHERE c = y),
m{i + 1} AS MATERIALIZED (SELECT c, j, b - {FIT_RATE} * g / (SELECT sum(w) FROM d WHERE NOT val) AS b FROM m{i}
  JOIN (SELECT c, j, sum((p - CAST(c = f.y AS INTEGER)) * f.w * v) AS g FROM p{i} JOIN f USING (vec_id)
        WHERE NOT f.val GROUP BY c, j) USING (c, j))"""
    every = " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(FIT_STEPS + 1))
    return sql + f"""
SELECT CAST(step AS INTEGER) AS step, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss,
  round(val_accuracy, 6) AS val_accuracy, val_loss = min(val_loss) OVER () AS best, val_accuracy > 0.3 AS learnt
FROM ({every})"""


@register("fit_curve", _curve_sql())
def fit_curve(spark, sf):
    """The softmax head fitted to a target that the vectors tell (the
    class of the rule-defined linear head), with class weights; losses on the
    training and the held-out split after each step, and whether the accuracy
    is far above chance (0.1 to 0.2 here)."""
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    rows = emb.withColumn("label", argmax(linear_scores("embedding"))).checkpoint()
    data = D.stratified_split(rows, "vec_id", "label", keep_all=True)
    train = data.where(F.col("split") == "train")
    weighted = D.with_weights(train, D.class_weights(train))
    val = data.where(F.col("split") == "val")
    fit = fit_softmax(weighted, val, "embedding", "label", "weight", steps=FIT_STEPS, rate=FIT_RATE)
    curve = [(s.step, s.train_loss, s.val_loss, s.val_accuracy, s.step == fit.best) for s in fit.curve]
    steps = spark.createDataFrame(curve, "step int, train_loss double, val_loss double, val_accuracy double, best boolean")
    rounded = [F.round(c, 6).alias(c) for c in ("train_loss", "val_loss", "val_accuracy")]
    return steps.select("step", *rounded, "best", (F.col("val_accuracy") > 0.3).alias("learnt"))


@register("csv_roundtrip", W("SELECT image, prediction, batch_id FROM pred", S.PRED_SQL))
def csv_roundtrip(spark, sf):
    """S9 + S7 + P4: predictions written as CSV with header, one partition
    folder per batch id, then read back by header name."""
    out = work_dir(spark, "csv-predictions")
    write_partition(S.predictions(spark, sf).select("image", "prediction", "batch_id"), out, fmt="csv")
    back = read_part_csvs(spark, out, PREDICTION_SCHEMA)
    return back.select("image", "prediction", "batch_id")


@register(
    "metrics_csv_roundtrip",
    W("SELECT batch_id, num_images, duration_ms, round(ms_per_image, 6) AS ms_per_image FROM metrics", S.METRICS_SQL),
)
def metrics_csv_roundtrip(spark, sf):
    """S10 + S8 + W5: the timing table as CSV parts, read back, ordered by
    batch id."""
    out = work_dir(spark, "csv-metrics")
    write_partition(S.metrics(spark, sf), out, fmt="csv")
    back = read_part_csvs(spark, out, METRICS_SCHEMA)
    return back.select(
        "batch_id", "num_images", "duration_ms", F.round("ms_per_image", 6).alias("ms_per_image")
    ).orderBy("batch_id")
