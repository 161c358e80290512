"""The scores of operators 6 and 10 against plain Python, document by document,
and the gradients of operator 10 against differences."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from lookout.llm import mil_quality as Q
from lookout.llm import ordinal_toxicity as X
from lookout.llm.words import find_words
from tests.conftest import SF01, SF001

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")


def hash_of(word: bytes, lower=False, inside=None) -> int:
    more = {} if inside is None else {"inside": inside}
    return int(find_words(pa.array([word.decode()]), lower=lower, **more).hash[0])


def plain_quality(text, model):
    """Passages, features, gated attention and score of one text."""
    words = WORD.findall((text or "").encode())
    parts = max(1, (len(words) + Q.PASSAGE // 2) // Q.PASSAGE)
    cuts = [words[k * Q.PASSAGE : (k + 1) * Q.PASSAGE if k < parts - 1 else None] for k in range(parts)]
    hs, es = [], []
    for p in cuts:
        n, safe = len(p), max(1, len(p))
        x = [float(n > 0), min(n, 100) / 100, sum(map(len, p)) / safe / 8, math.sqrt(sum(len(w) ** 2 for w in p) / safe) / 8]
        total = max(1, sum(map(len, p)))
        for group in Q.CLASSES:
            each = [sum(bool(group[b]) for b in w) for w in p]
            x += [sum(each) / total, sum(e > 0 for e in each) / safe]
        x.append(sum(len(w) <= 2 for w in p) / safe)
        x.append(sum(len(w) >= 12 for w in p) / safe)
        x.append(sum(w[-1:] in (b".", b"!", b"?") for w in p) / safe)
        x.append(sum(a == b for a, b in zip(p, p[1:])) / safe)
        x.append((n - len(set(p))) / safe)
        pairs = list(zip(p, p[1:]))
        x.append((len(pairs) - len(set(pairs))) / safe)
        bins = [0] * Q.HASHED
        for w in p:
            bins[hash_of(w) % Q.HASHED] += 1
        x += [b / safe for b in bins]
        x = np.clip((np.array(x, np.float32).astype(float) - model.mean) / model.scale, -8, 8)
        h = np.tanh(x @ model.p["W"] + model.p["b"])
        gate = 1 / (1 + np.exp(-(h @ model.p["U"])))
        hs.append(h)
        es.append(float((np.tanh(h @ model.p["V"]) * gate) @ model.p["w"]))
    a = [math.exp(e - max(es)) for e in es]
    z = sum(w / sum(a) * h for w, h in zip(a, hs, strict=True))
    return 1 / (1 + math.exp(-(float(z @ model.p["c"]) + model.p["d"][0])))


def plain_severity(text, weights, theta):
    """(P(toxic), expected severity, grade, hits) of one text."""
    counts, hits = {}, 0
    for word in LETTERS.findall((text or "").encode()):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        found = [("word", low)] + [(n, low[:n]) for n in X.PREFIXES if len(low) > n]
        found = [k for k in found if k in weights]
        hits += bool(found)
        for k in found:
            counts[k] = counts.get(k, 0) + 1
    s = sum(weights[k] * math.log1p(n) for k, n in counts.items())
    up = [1 / (1 + math.exp(-min(500, max(-500, s - t)))) for t in theta]
    return up[0], sum(up), sum(u >= 0.5 for u in up), hits


ODD = [None, "", " \t\n", "a", "word " * 24, "word " * 25, "word " * 74, "word " * 75 + "!", "é中文 " * 130, "x" * 5000]


def test_quality_score_is_that_of_the_plain_pass(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = Q.train(docs, labels, "doc_id", "text", "quality")
    texts = [r.text for r in docs.orderBy("doc_id").limit(25).collect()] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in Q.score(df, "text", model).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_quality(t, model), abs=1e-6), i


def test_severity_is_that_of_the_plain_pass(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = X.train(docs, labels, "doc_id", "text", "toxic")
    every = docs.orderBy("doc_id").collect()
    # Names of the model's features, from the texts that they were found in.
    names = {}
    for r in every:
        for word in set(LETTERS.findall((r.text or "").encode())):
            low = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
            for k in [("word", low)] + [(n, low[:n]) for n in X.PREFIXES if len(low) > n]:
                names.setdefault(k, None)
    weights = {}
    for kind, text in names:
        if kind == "word":
            key = find_words(pa.array([text], pa.binary()).cast(pa.string(), safe=False), lower=True, inside=X._LETTER).hash
        else:
            buf = np.frombuffer(text, np.uint8)
            key = X.mix(X.hash_spans(buf, np.array([0]), np.array([len(buf)]), lower=True) + X.U64(kind))
        at = int(model.index.find(key)[0])
        if at >= 0:
            weights[kind, text] = float(model.weight[at])
    assert len(weights) == len(model.weight) > 0
    texts = [r.text for r in every] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in X.score(df, "text", model).collect():
        want = plain_severity(texts[r.doc_id], weights, model.theta)
        assert (r.p_toxic, r.expected_severity) == pytest.approx(want[:2], abs=1e-9)
        assert (r.severity_grade, r.n_hits) == want[2:]


def test_attention_gradients_by_differences():
    rng = np.random.default_rng(5)
    sizes = [1, 4, 2, 7, 3]
    bag, y = np.repeat(np.arange(5), sizes), np.array([0.0, 1, 1, 0, 1])
    x, weight = rng.normal(size=(len(bag), 6)), rng.uniform(0.1, 1, 5)
    model = Q.Attention(6)
    for v in model.p.values():
        v += rng.normal(0, 0.3, v.shape)

    def loss():
        s = model.forward(x, bag, 5)["s"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    f = model.forward(x, bag, 5)
    got = model.gradient(f, bag, weight * (f["s"] - y))
    for name, value in model.p.items():
        flat, want = value.reshape(-1), np.zeros(value.size)
        for i in range(value.size):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up = loss()
            flat[i] = keep - 1e-6
            want[i] = (up - loss()) / 2e-6
            flat[i] = keep
        assert np.allclose(got[name].reshape(-1), want, atol=1e-6), name


def test_slices_add_up_to_the_whole(monkeypatch):
    rng = np.random.default_rng(6)
    bag = np.repeat(np.arange(60), rng.integers(1, 9, 60))
    x, y = rng.normal(size=(len(bag), 5)).astype(np.float32), (rng.random(60) < 0.5).astype(float)
    models = []
    for size in (1 << 14, 1, 17):
        monkeypatch.setattr(Q, "SLICE", size)
        models.append(Q.Attention(5))
        models[-1].fit(x, bag, y, steps=20)
    for other in models[1:]:
        for k, v in models[0].p.items():
            assert np.allclose(v, other.p[k], atol=1e-8), k


def test_no_cap_on_features(spark, make_docs):
    """As many telling words as there are, all in the model."""
    rows = [(i, " ".join(f"q{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100 % 10]}z" for k in range(1000)) if i % 2 else "plain words here") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    model = X.train(make_docs(rows), labels, "doc_id", "text", "toxic")
    assert len(model.weight) > 1000
