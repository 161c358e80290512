"""Findings on memory: what the tasks of operator 9 hold and hand on, what a
worker keeps when its task has ended, and what the pipeline's stages hold."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lookout.llm import backoff_lm, words
from lookout.llm import mil_quality as Q
from lookout.llm import substring_dedup as S
from lookout.llm.words import U64


def _plain(texts):
    words = [w for t in texts for w in [*t.split(), None]]
    return {w: words.count(w) for w in set(words)}


def test_counts_are_added_once_behind_the_shuffle(spark):
    texts = spark.createDataFrame([("a b a",), ("b c",), ("",)], "text string")
    found = backoff_lm._count(texts, lambda t: t.hash)
    assert sorted(r["n"] for r in found.collect()) == sorted(_plain(["a b a", "b c", ""]).values())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan  # rows that a task has combined aren't combined by it again


def test_small_chunks_give_the_same_counts_in_small_batches(spark, monkeypatch):
    text = " ".join(f"w{i % 50} x{i % 7}" for i in range(2_000))
    texts = spark.createDataFrame([(text,)] * 4, "text string").coalesce(1)
    get = lambda: {r["key"]: r["n"] for r in backoff_lm._count(texts, lambda t: t.hash).collect()}
    whole = get()
    assert sorted(whole.values()) == sorted(_plain([text] * 4).values())
    sizes = []
    real = pa.record_batch

    def seen(*args, **kwargs):
        batch = real(*args, **kwargs)
        sizes.append(batch.num_rows)
        return batch

    for name, value in (("HELD", 40), ("SENT", 10), ("COUNTED", 1_000)):
        monkeypatch.setattr(backoff_lm, name, value)
    assert get() == whole
    monkeypatch.setattr(backoff_lm.pa, "record_batch", seen)
    keys = np.arange(25, dtype=U64)
    parts = [[keys, keys + U64(1), np.ones(25, np.int64)], [keys[::-1], keys[::-1] + U64(1), np.full(25, 2)]]
    key, value, n = backoff_lm._merged(parts)
    assert key.tolist() == list(range(25)) and value.tolist() == list(range(1, 26)) and n.tolist() == [3] * 25


def test_a_worker_gives_freed_arrays_back(spark):
    def run(batches):
        import lookout.llm.words  # noqa: F401 - sets what the worker keeps

        def held():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4096 / 1e6

        for _ in batches:
            first = np.ones(3_000_000)  # freed once, the C library holds on to such arrays
            del first
            before = held()
            arrays, pins = [], []
            for _ in range(20):
                arrays.append(np.ones(1_000_000))
                pins.append(bytearray(100_000))  # lies behind each on the heap
            del arrays
            yield pa.record_batch([pa.array([held() - before])], names=["mb"])

    from lookout.session import prepare

    prepare(spark)
    rows = spark.range(1, numPartitions=1).mapInArrow(run, "mb double").agg(F.max("mb").alias("mb")).first()
    assert rows["mb"] < 40


@pytest.mark.parametrize("part", ["training", "scoring", "windows"])
def test_scratch_of_a_batch_of_texts_is_bounded(part):
    texts = pa.array([" ".join(f"w{i * k % 977}" for i in range(800)) for k in range(1, 1001)])
    assert texts.nbytes > 3_000_000
    batch = pa.record_batch([texts, pa.array([1] * 1000, pa.int32()), pa.array(range(1000))], names=["text", "label", "draw"])
    model = Q.Attention(Q.features(words.find_words(pa.array([""])))[1].shape[1])
    run = {
        "training": lambda: [len(b) for b in Q._bags([batch])],
        "scoring": lambda: len(Q._scores(texts, model)),
        "windows": lambda: [len(b) for b in S._counted([batch], S.WINDOW, S.ANCHOR)],
    }[part]
    tracemalloc.start()
    try:
        run()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60_000_000


def test_small_pieces_give_the_same_scores_and_bags(monkeypatch):
    texts = pa.array(["", "a", "b c #1 " * 300, None, *(" ".join(f"w{i * k % 97}" for i in range(7 * k)) for k in range(1, 60))])
    texts = texts.fill_null("")
    model = Q.Attention(Q.features(words.find_words(pa.array([""])))[1].shape[1])
    model.p["c"] += np.arange(Q.HIDDEN) - 7.0
    n = len(texts)
    batch = pa.record_batch([texts, pa.array([0] * n, pa.int32()), pa.array(range(n))], names=["text", "label", "draw"])
    found = []
    for most in (1 << 30, 100):
        monkeypatch.setattr(Q, "MEASURED", most)
        found.append((Q._scores(texts, model).to_numpy(), pa.Table.from_batches(Q._bags([batch])).to_pydict()))
    np.testing.assert_allclose(found[0][0], found[1][0], rtol=1e-12)
    assert found[0][1] == found[1][1] and len(found[0][1]["x"]) == n


def test_kept_tables_go_when_a_later_stage_uses_the_worker(monkeypatch):
    made = []

    def tables(key):
        return words.kept(key, lambda: made.append(key) or [key])

    monkeypatch.setattr(words, "_KEPT", {})
    assert tables("a") is tables("a") and made == ["a"]
    Q._scores(pa.array(["some text"]), Q.Attention(Q.features(words.find_words(pa.array([""])))[1].shape[1]))
    tables("a")
    assert made == ["a"]  # asked for just now
    monkeypatch.setattr(words, "IDLE", -1)
    list(Q._bags([]))
    assert not words._KEPT
    tables("b")
    tables("a")
    assert made == ["a", "b", "a"] and list(words._KEPT) == ["a"]  # those of one key


def test_stages_read_parquet_in_bounded_batches(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    try:
        spark.conf.unset(key)
        corpus_pipeline.bound_batches(spark)
        assert int(spark.conf.get(key)) <= 1024
        spark.conf.set(key, "16")
        corpus_pipeline.bound_batches(spark)
        assert spark.conf.get(key) == "16"
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
