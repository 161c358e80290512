"""Streaming: arrivals in several batches, restart from the checkpoint,
replayed batch, corrupt file, wrong extension."""

import os

import numpy as np
from pyspark.sql import functions as F

from lookout.sources.tables import METRICS_SCHEMA, PREDICTION_SCHEMA, read_or_empty
from lookout.streaming.classify import start_image_classifier
from lookout.streaming.sink import BatchSink
from tests import pngs


def _drop(folder, names, seed):
    rng = np.random.default_rng(seed)
    for n in names:
        pngs.write(f"{folder}/{n}", rng.integers(0, 256, (10, 12, 3)))


def test_restart_each_file_scored_once(spark, tmpdir_fresh):
    src, base = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    os.makedirs(src)
    out, met, ckpt = f"{base}/pred", f"{base}/metrics", f"{base}/ckpt"

    def run():
        q = start_image_classifier(spark, src, out, met, ckpt, height=8, width=8, max_files_per_trigger=1)
        q.awaitTermination()
        return q

    _drop(src, ["a1.png", "a2.png"], 1)
    run()
    _drop(src, ["b1.png", "b2.jpg"], 2)
    with open(f"{src}/bad.png", "wb") as f:
        f.write(b"not a png")
    with open(f"{src}/skip.txt", "w") as f:
        f.write("x")
    run()
    _drop(src, ["c1.png", "c2.png"], 3)
    run()
    run()  # nothing new: no batch
    preds = read_or_empty(spark, out, PREDICTION_SCHEMA)
    names = sorted(r.image.rsplit("/", 1)[-1] for r in preds.collect())
    assert names == ["a1.png", "a2.png", "b1.png", "b2.jpg", "c1.png", "c2.png"]
    assert preds.where(~F.col("prediction").rlike("^[0-9]$")).count() == 0
    metrics = read_or_empty(spark, met, METRICS_SCHEMA)
    # 7 matched files in 1-file batches; the undecodable one goes to rejects
    assert metrics.agg(F.sum("num_images")).first()[0] == 6
    assert metrics.where(F.col("ms_per_image") < 0).count() == 0
    rejects = spark.read.parquet(f"{base}/rejects").collect()
    assert [(r.image.rsplit("/", 1)[-1], r.error) for r in rejects] == [("bad.png", "undecodable_image")]


def test_replayed_batch_is_idempotent(spark, tmpdir_fresh):
    out, met = f"{tmpdir_fresh}/pred", f"{tmpdir_fresh}/metrics"
    sink = BatchSink(out, met)
    batch = spark.createDataFrame([("file:/x/a.png", "3", None), ("file:/x/b.png", "0", None)], "image string, prediction string, modification_time timestamp")
    sink(batch, 0)
    sink(batch.limit(1), 1)
    sink(batch, 0)  # replay of batch 0 after a failure
    preds = read_or_empty(spark, out, PREDICTION_SCHEMA)
    assert preds.count() == 3
    assert dict(preds.groupBy("batch_id").count().collect()) == {0: 2, 1: 1}
    metrics = read_or_empty(spark, met, METRICS_SCHEMA)
    assert sorted((r.batch_id, r.num_images) for r in metrics.collect()) == [(0, 2), (1, 1)]


def test_missing_result_is_empty_view(spark, tmpdir_fresh):
    df = read_or_empty(spark, f"{tmpdir_fresh}/nothing", PREDICTION_SCHEMA)
    assert df.count() == 0 and df.columns == PREDICTION_SCHEMA.fieldNames()


def test_binary_stream_declared_schema(spark, tmpdir_fresh):
    from lookout.sources.images import BINARY_SCHEMA, read_binary_stream

    src = f"{tmpdir_fresh}/in"
    _drop(src, ["x1.png", "x2.jpeg"], 7)
    with open(f"{src}/x3.PNG", "wb") as f:
        f.write(b"upper-case suffix: not matched by the glob")
    stream = read_binary_stream(spark, src, max_files_per_trigger=1)
    assert stream.schema == BINARY_SCHEMA
    out = f"{tmpdir_fresh}/out"
    q = (
        stream.select("path", "length")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{tmpdir_fresh}/ck")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = sorted(r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(out).collect())
    assert got == ["x1.png", "x2.jpeg"]


EVENT = "image string, prediction string, modification_time timestamp"


def _source(spark, folder):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)


def _add(spark, folder, rows):
    spark.createDataFrame([(*r, None) for r in rows], EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_live_class_counts_follow_new_batches(spark, tmpdir_fresh):
    from lookout.streaming.classify import read_live_table, start_live_class_counts

    src, table = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/live"
    assert read_live_table(spark, table) is None
    _add(spark, src, [("file:/a.png", "0"), ("file:/b.png", "4")])
    q = start_live_class_counts(_source(spark, src), table, f"{tmpdir_fresh}/ck", trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert {r.class_id: r.n_images for r in read_live_table(spark, table).collect()} == {0: 1, 4: 1}
        _add(spark, src, [("file:/c.png", "4"), ("file:/d.png", "10")])
        q.processAllAvailable()
        rows = {r.class_id: (r.class_name, r.n_images) for r in read_live_table(spark, table).collect()}
        assert rows[4][1] == 2 and rows[0][1] == 1 and rows[10] == (None, 1)
        assert rows[4][0] == "c4: Téléphone (Gauche)"
    finally:
        q.stop()


def test_live_counts_after_replay_and_after_reset(spark, tmpdir_fresh):
    from lookout.streaming.classify import read_live_table, start_live_class_counts

    src, table, ckpt = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/live", f"{tmpdir_fresh}/ck"

    def run(checkpoint):
        start_live_class_counts(_source(spark, src), table, checkpoint).awaitTermination()
        return {r.class_id: r.n_images for r in read_live_table(spark, table).collect()}

    _add(spark, src, [("a", "1"), ("b", "1"), ("c", "5")])
    assert run(ckpt) == {1: 2, 5: 1}
    for name in ("0", ".0.crc"):  # written, not committed: Spark runs the batch again
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    assert run(ckpt) == {1: 2, 5: 1}
    _add(spark, src, [("d", "5")])
    assert run(f"{tmpdir_fresh}/new-ck") == {1: 2, 5: 2}  # a new run counts anew
    both = {r.class_id: r.n_images for r in read_live_table(spark, table, every_run=True).collect()}
    assert both == {1: 4, 5: 3}


def test_two_runs_into_one_folder(spark, tmpdir_fresh):
    """A new checkpoint adds to what an earlier run wrote, and the page shows
    the newest rows although metrics outlive the predictions of a reset."""
    import shutil

    from lookout.operators import views as V

    src, base = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    os.makedirs(src)
    out, met = f"{base}/pred", f"{base}/metrics"

    def run(name):
        q = start_image_classifier(spark, src, out, met, f"{base}/{name}", height=8, width=8, max_files_per_trigger=1)
        q.awaitTermination()

    _drop(src, ["old1.png", "old2.png", "old3.png"], 5)
    run("ck-a")
    os.remove(f"{src}/old1.png")
    os.remove(f"{src}/old2.png")
    os.remove(f"{src}/old3.png")
    _drop(src, ["new.png"], 6)
    run("ck-b")
    preds = read_or_empty(spark, out, PREDICTION_SCHEMA)
    names = sorted(r.image.rsplit("/", 1)[-1] for r in preds.collect())
    assert names == ["new.png", "old1.png", "old2.png", "old3.png"]
    assert preds.select("run_id").distinct().count() == 2
    assert read_or_empty(spark, met, METRICS_SCHEMA).count() == 4
    page = V.page(spark, out, met, recent=3)
    assert page["latest"].first().file_name == "new.png"
    assert [r.file_name for r in page["recent"].collect()][0] == "new.png" and page["recent"].count() == 3
    # The usual reset: output and checkpoint go, metrics stay.
    shutil.rmtree(out)
    shutil.rmtree(f"{base}/ck-b")
    run("ck-c")
    page = V.page(spark, out, met, recent=3)
    assert page["total_images"].first().total_images == 1
    assert page["latest"].first().file_name == "new.png" and page["recent"].count() == 1


def test_progress_reports_become_a_table(spark, tmpdir_fresh):
    import time

    from lookout.streaming.classify import ProgressLog, progress_table, start_table_stream

    src, log = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/log"
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for i in range(3):
            _add(spark, src, [(f"{i}", "1")])
        q = start_table_stream(_source(spark, src), f"{tmpdir_fresh}/o", f"{tmpdir_fresh}/m", f"{tmpdir_fresh}/c")
        q.awaitTermination()
        for _ in range(60):
            rows = [r for r in progress_table(spark, log).collect() if r.query_id == q.id and r.num_input_rows]
            if len(rows) == 3:
                break
            time.sleep(0.5)
        assert [r.batch_id for r in rows] == [0, 1, 2] and all(r.trigger_ms >= 0 for r in rows)
    finally:
        spark.streams.removeListener(listener)


def test_consumer_waits_unless_told_otherwise(monkeypatch):
    from lookout.streaming import __main__ as M

    seen = []

    class Query:
        def awaitTermination(self):  # noqa: N802
            pass

    monkeypatch.setattr(M, "start_image_classifier", lambda *a, **k: seen.append(k["trigger"]) or Query())
    for flags in ([], ["--available-now"], ["--trigger-seconds", "5"]):
        M.main(["--input", "i", "--output", "o", *flags])
    assert seen == [{"processingTime": "0 seconds"}, {"availableNow": True}, {"processingTime": "5.0 seconds"}]


def test_spark_replay_after_crash_is_exactly_once(spark, tmpdir_fresh):
    """A crash after the sink wrote batch N but before the commit log recorded
    it makes Spark re-run batch N on restart; the per-batch overwrite keeps
    one copy."""
    src, base = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    os.makedirs(src)
    out, met, ckpt = f"{base}/pred", f"{base}/metrics", f"{base}/ckpt"
    _drop(src, ["a.png", "b.png", "c.png"], 9)

    def run():
        q = start_image_classifier(spark, src, out, met, ckpt, height=8, width=8, max_files_per_trigger=2)
        q.awaitTermination()

    run()
    commits = sorted(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    assert commits == [0, 1]
    # the crash: batch 1 written, not committed (the local file system keeps
    # a checksum file next to each log entry)
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    run()
    preds = read_or_empty(spark, out, PREDICTION_SCHEMA)
    assert sorted(r.image.rsplit("/", 1)[-1] for r in preds.collect()) == ["a.png", "b.png", "c.png"]
    metrics = read_or_empty(spark, met, METRICS_SCHEMA)
    assert sorted((r.batch_id, r.num_images) for r in metrics.collect()) == [(0, 2), (1, 1)]
