"""a stream of many small images spends its time on the images."""

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq

from lookout.plans import q_streaming
from lookout.plans.fixtures import write_png_files
from lookout.session import settings
from lookout.sources import commits
from lookout.sources.tables import METRICS_SCHEMA, PREDICTION_SCHEMA, read_or_empty
from lookout.streaming import classify, sink
from tests import pngs

ROWS = 150
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
SCORED = "image string, prediction string, modification_time timestamp, error string"


def _embeddings(folder):
    vectors = [[((7 * i + 3 * j) % 201 - 100) / 100 for j in range(64)] for i in range(ROWS)]
    table = pa.table(
        {
            "vec_id": pa.array(range(ROWS), pa.int64()),
            "embedding": pa.array(vectors, pa.list_(pa.float32())),
            "label": pa.array([i % 10 for i in range(ROWS)], pa.int32()),
        }
    )
    pq.write_table(table, f"{folder}/embeddings.parquet")
    return vectors


def _expected(vectors):
    out = {}
    for i, vector in enumerate(vectors):
        rgb = [int((pa.scalar(x, pa.float32()).as_py() + 1) * 127.5 // 1) / 255 for x in vector for _ in range(3)]
        scores = [sum(((7 * c + 3 * k) % 11 - 5) / 10 * v for k, v in enumerate(rgb)) + c / 100 for c in range(10)]
        out[i] = str(scores.index(max(scores)))
    return out


def _tasks(spark, group):
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return [info.numTasks for s in stages if (info := tracker.getStageInfo(s)) is not None]


def test_images_are_listed_and_read_in_few_tasks(spark, tmpdir_fresh, monkeypatch):
    vectors = _embeddings(tmpdir_fresh)
    begun = []
    start = classify.start_image_classifier
    monkeypatch.setattr(classify, "start_image_classifier", lambda *a, **k: begun.append(start(*a, **k)) or begun[-1])
    before = spark.conf.get(LISTING, None)
    found = q_streaming.stream_image_predictions(spark, tmpdir_fresh)
    assert {r.vec_id: r.prediction for r in found.collect()} == _expected(vectors)
    assert found.count() == ROWS
    tasks = _tasks(spark, str(begun[0].runId))
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert tasks and max(tasks) <= cores < ROWS
    assert spark.conf.get(LISTING, None) == before


def test_images_of_one_row_group_are_written_by_every_core(spark, tmpdir_fresh):
    _embeddings(tmpdir_fresh)
    spark.sparkContext.setJobGroup("export", "export")
    try:
        root = q_streaming.export_features(spark, tmpdir_fresh)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(_tasks(spark, "export")) >= spark.sparkContext.defaultParallelism
    here = root.removeprefix("file:")
    assert sorted(n for n in os.listdir(here) if n.endswith(".png")) == sorted(f"img_{i}.png" for i in range(ROWS))
    assert not [n for n in os.listdir(here) if n.startswith(".writing")]


def test_images_are_written_again_over_the_same_names(spark, tmpdir_fresh):
    rows = spark.createDataFrame([(1, [0] * 4, "a"), (2, [9] * 4, "b")], "id long, px array<int>, folder string")
    for _ in range(2):
        made = write_png_files(rows, f"{tmpdir_fresh}/png", "id", "px", 2, 2, 1, ("folder",)).collect()
        assert sorted(r.path[-12:] for r in made) == ["/a/img_1.png", "/b/img_2.png"]
    assert sorted(os.listdir(f"{tmpdir_fresh}/png")) == ["a", "b"]


def test_row_writers_are_the_query_s_own(spark, tmpdir_fresh):
    os.makedirs(f"{tmpdir_fresh}/in")
    before = {k: spark.conf.get(k, None) for k in classify.ROW_WRITERS}
    pngs.write(f"{tmpdir_fresh}/in/a.png", [[[1, 2, 3]]])
    base = f"{tmpdir_fresh}/out"
    q = classify.start_image_classifier(spark, f"{tmpdir_fresh}/in", f"{base}/p", f"{base}/m", f"{base}/c", 2, 2)
    assert {k: spark.conf.get(k, None) for k in classify.ROW_WRITERS} == before
    q.awaitTermination()
    assert read_or_empty(spark, f"{base}/p", PREDICTION_SCHEMA).count() == 1


def _batch(spark, *rows):
    return spark.createDataFrame([(f"file:/{name}", prediction, None, error) for name, prediction, error in rows], SCORED)


def test_batches_without_rejects_are_not_read_for_them(spark, tmpdir_fresh, monkeypatch):
    """One log is listed once for each table, not once for each batch; rejects
    are found in mixed batches and in batches of nothing else."""
    base = f"{tmpdir_fresh}/out"
    listed = []
    real = commits.snapshot
    monkeypatch.setattr(commits, "snapshot", lambda s, p: listed.append(p) or real(s, p))
    written = []
    write = sink.write_attempt
    monkeypatch.setattr(sink, "write_attempt", lambda df, path, *a: written.append(path[-3:]) or write(df, path, *a))
    s = sink.BatchSink(f"{base}/pre", f"{base}/met", rejects_dir=f"{base}/rej", checkpoint=f"{base}/ck")
    s._run = "run-1"
    broken = ("b.png", None, classify.UNDECODABLE)
    s(_batch(spark, ("a.png", "1", None), ("c.png", "2", None)), 0)
    s(_batch(spark, broken), 1)
    s(_batch(spark, broken, ("d.png", "3", None)), 2)
    s(_batch(spark), 3)
    assert sorted(listed) == sorted(f"{base}/{t}" for t in ("pre", "met", "rej"))
    assert written == ["pre", "pre", "rej", "pre", "rej", "pre"]

    def held(name, schema, *columns):
        return sorted(tuple(r) for r in read_or_empty(spark, f"{base}/{name}", schema).select(*columns).collect())

    images = ("batch_id", "image")
    assert held("pre", PREDICTION_SCHEMA, *images) == [(0, "file:/a.png"), (0, "file:/c.png"), (2, "file:/d.png")]
    assert held("met", METRICS_SCHEMA, "batch_id", "num_images") == [(0, 2), (2, 1)]
    assert held("rej", PREDICTION_SCHEMA, *images) == [(1, "file:/b.png"), (2, "file:/b.png")]
    # Batch 2 once more, by this sink and by one after a restart: it is replaced.
    s(_batch(spark, ("d.png", "3", None)), 2)
    assert held("rej", PREDICTION_SCHEMA, *images) == [(1, "file:/b.png")]
    again = sink.BatchSink(f"{base}/pre", f"{base}/met", rejects_dir=f"{base}/rej", checkpoint=f"{base}/ck")
    again._run = "run-1"
    again(_batch(spark, ("e.png", "4", None)), 2)
    again(_batch(spark, ("f.png", "5", None)), 4)
    assert held("pre", PREDICTION_SCHEMA, *images)[2:] == [(2, "file:/e.png"), (4, "file:/f.png")]
    files = glob.glob(f"{base}/met/run_id=run-1/batch_id=0/*/*.parquet")
    assert [spark.read.parquet(f).dtypes for f in files] == [
        [("num_images", "bigint"), ("duration_ms", "bigint"), ("ms_per_image", "double")]
    ]


def test_settings_are_put_back(spark):
    key, own = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes", None)
    try:
        with settings(spark, {key: "1m", "lookout.none": "x"}):
            assert spark.conf.get(key) == "1m" and spark.conf.get("lookout.none") == "x"
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(key, None) == own and spark.conf.get("lookout.none", None) is None
