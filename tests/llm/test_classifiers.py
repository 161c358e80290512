import zlib

import numpy as np
import pyarrow as pa
import pytest

from lookout.llm import mil_quality as Q
from lookout.llm import ordinal_toxicity as X
from lookout.llm.queries import op6, op10
from lookout.llm.words import find_words
from tests.conftest import SF01


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    n1, n0 = pos.sum(), (~pos).sum()
    return (rank[pos].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}


def test_quality_on_held_out_documents(spark, labels):
    rows = op10(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id].quality for r in held])
    assert auc(np.array([r.score for r in held]), y) > 0.95
    assert np.mean([r.predicted for r in held] == y) > 0.95


def test_toxicity_on_held_out_documents(spark, labels):
    rows = op6(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.expected_severity <= 3 and 0 <= r.severity_grade <= 3
        assert r.toxic == (r.p_toxic >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id].toxic for r in held])
    got = np.array([r.toxic for r in held])
    assert (got[y == 0] == 0).mean() > 0.97
    assert (got[y == 1] == 1).mean() > 0.7


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    quality = Q.train(docs, none, "doc_id", "text", "quality")
    out = Q.score(docs, "text", quality)
    assert set(out.columns) == set(docs.columns) and {r.score for r in out.collect()} == {0.5}
    toxic = X.train(docs, none, "doc_id", "text", "toxic")
    out = X.score(docs, "text", toxic).collect()
    assert len(out) == len(odd_rows) and all(r.expected_severity < 1e-6 and r.severity_grade == 0 for r in out)
    some = spark.createDataFrame([(1, 0, 0), (4, 1, 1), (4, 0, 0), (5, 1, 0), (None, 1, 1), (6, None, None), (8, 0, 1)], none.schema)
    model = Q.train(docs, some, "doc_id", "text", "quality")
    assert all(0 <= r.score <= 1 for r in Q.score(docs, "text", model).collect())
    assert len(X.score(docs, "text", X.train(docs, some, "doc_id", "text", "toxic")).collect()) == len(odd_rows)
    empty = make_docs([])
    assert Q.score(empty, "text", model).collect() == [] and X.score(empty, "text", toxic).collect() == []


def test_passages_cover_every_word():
    texts = pa.array(["", *(" ".join("w" for _ in range(n)) for n in (1, 49, 50, 74, 75, 100, 1234))])
    w = find_words(texts)
    text, first, last = Q.passages(w)
    assert set(text) == set(range(len(texts)))
    for t in range(len(texts)):
        mine = np.flatnonzero(text == t)
        assert first[mine[0]] == w.first[t] and last[mine[-1]] == w.first[t + 1]
        assert (first[mine[1:]] == last[mine[:-1]]).all()


def test_attention_gradient():
    """The fitted direction lowers the loss, and attention finds the telling passage."""
    rng = np.random.default_rng(0)
    bags, y, xs = [], [], []
    for i in range(200):
        x = rng.normal(size=(5, 6))
        label = i % 2
        if not label:
            x[rng.integers(5), 2] += 6
        xs.append(x)
        bags += [i] * 5
        y.append(label)
    model = Q.Attention(6)
    model.fit(np.concatenate(xs), np.array(bags), np.array(y, float))
    s = model.forward(np.concatenate(xs), np.array(bags), 200)["s"]
    assert auc(s, np.array(y)) > 0.99


def test_ordinal_thresholds_stay_ordered_and_recover_grades():
    rng = np.random.default_rng(1)
    n = 600
    value = rng.uniform(0, 4, n)
    grade = np.clip(value + rng.normal(0, 0.2, n), 0, 3).astype(int)
    m = X.Ordinal(np.array([1], np.uint64), 4)
    m.fit(np.arange(n), np.zeros(n, np.int64), value, grade)
    assert (np.diff(m.theta) > 0).all()
    up = m.above(m.linear(np.arange(n), np.zeros(n, np.int64), value, n))
    assert (np.diff(up, axis=1) <= 1e-12).all()
    assert np.abs(up.sum(axis=1) - grade).mean() < 0.4


def test_word_features_share_prefixes():
    feats = X.word_features(pa.array(["Badword, badwords! bad", "", "BADWORK"]))
    assert len(feats) == 1 + len(X.PREFIXES)
    four = feats[1]
    assert len(set(four[0].tolist())) == 1 and four[1].tolist() == [0, 0, 2]


def test_words_that_clean_documents_use_too_still_tell(spark, make_docs):
    """A word twelve times as common in toxic documents finds those that are
    toxic through nothing else; with no stronger word there is still a model."""
    rng = np.random.default_rng(3)
    plain = lambda: list(rng.choice([f"w{chr(97 + i)}x" for i in range(20)], 15))
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        words = plain()
        if rng.random() < (0.96 if toxic else 0.08):
            words.insert(4, "vile")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.train(make_docs(rows), table, "doc_id", "text", "toxic")
    new = make_docs([(1000, " ".join([*plain(), "vile"])), (1001, " ".join(plain()))])
    got = {r.doc_id: r.p_toxic for r in X.score(new, "text", model).collect()}
    assert got[1000] > 0.5 > got[1001]


def test_training_bags_hold_every_passage(spark):
    texts = pa.array([" ".join(f"w{j % 50}" for j in range(n)) for n in (9000, 40, 400)])
    batch = pa.record_batch([texts, pa.array([0, 1, 1], pa.int32()), pa.array([5, 7, 6])], names=["text", "label", "draw"])
    (out,) = Q._bags([batch])
    text, x = Q.features(find_words(texts))
    assert out.column("n").to_pylist() == np.bincount(text).tolist()
    assert b"".join(out.column("x").to_pylist()) == x.tobytes()
    bags = spark.createDataFrame(out.select(["label", "draw", "n"]).to_pandas())
    kept = lambda most: {r.draw for r in bags.where(Q._within(bags, most)).collect()}
    assert kept(1 << 18) == {5, 6, 7} and kept(3) == {5, 6}
