"""The streaming classifier (T1, T3, S13, P1-P3) and the live class counts
(T4).

``image folder --readStream image (JVM decode)--> resize + score in one
Arrow pass (mapInPandas, model cached per Python worker) --> foreachBatch
idempotent sink``. The stream is stateless: each file is read once (the
checkpoint's file log), scored and written under its batch id;
undecodable files go to a rejects table under the same batch id.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lookout.classes import class_dim
from lookout.functions.images import pixel_vectors
from lookout.operators.scoring import LinearModel, cached_predict, prediction_text, score_udf, with_scores
from lookout.session import prepare, settings
from lookout.sources.images import StreamLimits, image_features, read_image_stream, split_valid
from lookout.sources.commits import commit, read_committed, snapshot, vacuum, write_attempt
from lookout.sources.tables import path_exists, read_or_empty
from lookout.streaming.sink import BatchSink, run_of

CLASSIFIED_SCHEMA = "image string, prediction string, modification_time timestamp, error string"
UNDECODABLE = "undecodable_image"


def classify_images(
    images: DataFrame,
    height: int = 64,
    width: int = 64,
    make_predict_fn=None,
    batch_size: int = 64,
    antialias: bool | str = False,
    fused: bool = True,
) -> DataFrame:
    """Decoded images -> ``image, prediction, modification_time,
    error``; ``error`` is set (and ``prediction`` null) for an undecodable
    file. Pixels exist only inside the scoring step; they are never written.

    ``fused`` (default): one ``mapInPandas`` pass resizes and scores each
    Arrow batch (``batch_size`` rows per model call), so pixel vectors never
    travel back to the JVM. Otherwise the pixel UDF feeds
    ``predict_batch_udf`` (two Python round trips)."""
    make = make_predict_fn or LinearModel.rule(height * width * 3).make_predict_fn()
    if fused:
        return _classify_fused(images, height, width, make, batch_size, antialias)
    good, _ = split_valid(images)
    feats = image_features(good, height, width, antialias)
    scored = with_scores(feats, "pixels", score_udf(make, [height, width, 3], batch_size))
    ok = scored.select(
        F.col("path").alias("image"),
        prediction_text(F.col("y_pred")).alias("prediction"),
        "modification_time",
        F.lit(None).cast("string").alias("error"),
    )
    # The same filter as split_valid's rejects, keeping the file time: no
    # join of the (wide) image rows.
    undecodable = ~(F.col("image.height") > 0) | F.col("image.height").isNull()
    rejected = images.where(undecodable).select(
        F.col("path").alias("image"),
        F.lit(None).cast("string").alias("prediction"),
        "modification_time",
        F.lit(UNDECODABLE).alias("error"),
    )
    return ok.unionByName(rejected)


def _classify_fused(images: DataFrame, height: int, width: int, make, batch_size: int, antialias: bool | str) -> DataFrame:
    prepare(images.sparkSession)
    key = uuid.uuid4().hex  # one model per worker for this query (cached_predict keeps a few)
    im = F.col("image")
    src = images.select(
        F.col("path").alias("image"),
        "modification_time",
        im["data"].alias("data"),
        im["height"].alias("h"),
        im["width"].alias("w"),
        im["nChannels"].alias("c"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = cached_predict(key, make)
        for pdf in batches:
            vecs = pixel_vectors(pdf["data"], pdf["h"], pdf["w"], pdf["c"], height, width, antialias)
            ok = [i for i, v in enumerate(vecs) if v is not None]
            pred = np.full(len(pdf), None, dtype=object)
            if ok:
                x = np.stack([vecs[i] for i in ok]).reshape(len(ok), height, width, 3)
                cls = np.concatenate(
                    [np.argmax(predict(x[s : s + batch_size]), axis=1) for s in range(0, len(ok), batch_size)]
                )
                pred[ok] = cls.astype(str)
            err = np.where(pd.isna(pred), UNDECODABLE, None)
            yield pd.DataFrame(
                {"image": pdf["image"], "prediction": pred, "modification_time": pdf["modification_time"], "error": err}
            )

    return src.mapInPandas(run, CLASSIFIED_SCHEMA)


def _start(df: DataFrame, sink, checkpoint: str, trigger: dict | None, name: str | None, mode: str = "append"):
    writer = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


# The image source builds a row writer for every file. Compiled, and searched for
# common expressions, that costs several times the decoding of a small image;
# interpreted writers copy the same bytes.
ROW_WRITERS = {"spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.subexpressionElimination.enabled": "false"}


def many_small_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings for a session while it streams folders of many small files;
    the source asks its session for them in every batch. The files of a batch
    are listed in as many tasks as the session shuffles with (not a task a
    file) and, opening a file being cheap next to a Python task, read in about
    as many as there are cores. The list of all files read so far is rewritten
    every 100 batches (not every 10th)."""
    return settings(
        spark,
        {
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": spark.conf.get("spark.sql.shuffle.partitions"),
            "spark.sql.files.openCostInBytes": "64k",
            "spark.sql.streaming.fileSource.log.compactInterval": "100",
        },
    )


def start_image_classifier(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    metrics_dir: str,
    checkpoint: str,
    height: int = 64,
    width: int = 64,
    make_predict_fn=None,
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
    fmt: str = "parquet",
    antialias: bool | str = False,
    rejects_dir: str | None = None,
    fused: bool = True,
    limits: StreamLimits = StreamLimits(),
) -> StreamingQuery:
    """Start the classification stream. ``trigger`` defaults to
    ``availableNow`` (drain and stop); pass ``{"processingTime": "5
    seconds"}`` for a long-running query. Restarting with the same
    checkpoint resumes after the last committed batch (T3). Undecodable
    files go to ``rejects_dir`` (default: a ``rejects`` folder next to the
    metrics). ``limits`` says what a batch admits and what becomes of files
    that were read. Start it and wait for it inside :func:`many_small_files`
    where a batch has hundreds of files."""
    prepare(spark)
    rejects_dir = rejects_dir or metrics_dir.rstrip("/").rsplit("/", 1)[0] + "/rejects"
    images = read_image_stream(spark, input_dir, max_files_per_trigger=max_files_per_trigger, limits=limits)
    preds = classify_images(images, height, width, make_predict_fn, antialias=antialias, fused=fused)
    sink = BatchSink(output_dir, metrics_dir, fmt, rejects_dir, checkpoint)
    with settings(spark, ROW_WRITERS):  # the query keeps those of its start
        return _start(preds, sink, checkpoint, trigger, None)


def start_table_stream(
    source: DataFrame,
    output_dir: str,
    metrics_dir: str | None,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """T1/T2 for an already-transformed streaming DataFrame (any source)."""
    prepare(source.sparkSession)
    return _start(source, BatchSink(output_dir, metrics_dir, checkpoint=checkpoint), checkpoint, trigger, None)


class CountSink:
    """``foreachBatch`` sink of the live class counts: each trigger gives the
    counts so far (a handful of rows, from the query's state), which are
    committed as its batch; readers take the newest one of a run. What older
    triggers wrote is deleted in passing, after a while."""

    VACUUM_EVERY, KEEP_SECONDS = 100, 600

    def __init__(self, path: str, checkpoint: str):
        self.path = path.rstrip("/")
        self.checkpoint = checkpoint
        self._run: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._run is None:
            self._run = run_of(spark, self.checkpoint)
        commit(spark, self.path, self._run, batch_id, write_attempt(batch.coalesce(1), self.path, self._run, batch_id))
        if batch_id % self.VACUUM_EVERY == self.VACUUM_EVERY - 1:
            forget_older(spark, self.path, self._run, batch_id)
            vacuum(spark, self.path, self.KEEP_SECONDS)


def forget_older(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """Commits the batches of a run before ``batch_id`` as empty: a newer one
    holds what they held."""
    for r, b in snapshot(spark, path).folders():
        if r == run and b < batch_id:
            commit(spark, path, r, b)


def class_totals(predictions: DataFrame) -> DataFrame:
    """Images per class id of a table or micro-batch (at most 11 rows)."""
    return predictions.groupBy(F.col("prediction").try_cast("int").alias("class_id")).agg(
        F.count(F.lit(1)).alias("n_images")
    )


def with_class_names(counts: DataFrame) -> DataFrame:
    """Names for the class counts: join with the 10-row dimension (unknown
    ids keep a null name)."""
    return counts.join(F.broadcast(class_dim(counts.sparkSession)), "class_id", "left").select(
        "class_id", "class_name", "n_images"
    )


COUNT_SCHEMA = T.StructType([T.StructField("class_id", T.IntegerType()), T.StructField("n_images", T.LongType())])
# Partitions of the counts' state: a few keys, whatever the stream brings.
STATE_PARTITIONS = 4


def read_live_table(spark: SparkSession, path: str, every_run: bool = False) -> DataFrame | None:
    """T4: running images per class of the newest run (or of all runs, as the
    page counts the predictions), or None before the first batch."""
    if not path_exists(spark, path):
        return None
    counts = read_committed(spark, path, COUNT_SCHEMA, newest=True)
    if not every_run:
        newest = counts.agg(F.max("run_id")).first()[0]
        if newest is None:
            return None
        counts = counts.where(F.col("run_id") == newest)
    return with_class_names(counts.groupBy("class_id").agg(F.sum("n_images").alias("n_images")))


def start_live_class_counts(
    predictions: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """T4: class counts of a stream of predictions, refreshed on every
    trigger; ``{"processingTime": "2 seconds"}`` matches the page's refresh.
    The counts are the query's state (``groupBy`` in complete mode): a restart
    goes on from the checkpointed state store and reads no old input, and a
    replayed batch starts from the state before it. The source must give each
    prediction once (the classified stream itself, not the folder that a
    :class:`BatchSink` rewrites on replay)."""
    spark = predictions.sparkSession
    prepare(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:  # the number of state partitions is that of the session when the query starts
        spark.conf.set("spark.sql.shuffle.partitions", STATE_PARTITIONS)
        return _start(class_totals(predictions), CountSink(table_path, checkpoint), checkpoint, trigger, None, "complete")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


PROGRESS_SCHEMA = (
    "query_id string, batch_id long, num_input_rows long, trigger_ms long, add_batch_ms long, get_batch_ms long, "
    "processed_rows_per_second double, timestamp string"
)


def _progress_row(p) -> tuple:
    d = json.loads(p.json) if hasattr(p, "json") else dict(p)
    dur = d.get("durationMs") or {}
    return (
        str(d.get("id", "")),
        int(d.get("batchId", -1)),
        int(d.get("numInputRows", 0) or 0),
        int(dur.get("triggerExecution", 0) or 0),
        int(dur.get("addBatch", 0) or 0),
        int(dur.get("getBatch", 0) or 0),
        float(d.get("processedRowsPerSecond", 0.0) or 0.0),
        str(d.get("timestamp", "")),
    )


class ProgressLog(StreamingQueryListener):
    """Q13: appends Spark's own report of every trigger (input rows and
    timings) to a table, next to the sink's timing rows. Add it with
    ``spark.streams.addListener(ProgressLog(spark, path))``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = self.spark.createDataFrame([_progress_row(event.progress)], PROGRESS_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """The reports that a :class:`ProgressLog` has written, oldest first."""
    schema = T.StructType.fromDDL(PROGRESS_SCHEMA)
    return read_or_empty(spark, path, schema).orderBy("timestamp", "batch_id")
