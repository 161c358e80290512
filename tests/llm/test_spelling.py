import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lookout.llm import spelling as S
from lookout.llm.queries import op11
from tests.conftest import SF001

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_counts(rows):
    found = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    by = {}
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        by[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in words:
        root = w
        while by[root] is not None:
            root = by[root]
        out[w] = (counts[w], len(near[w]), by[w], counts.get(by[w]), root)
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    counts = brute_counts(rows)
    got = op11(spark, SF001)
    assert dict(got.dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    got = found(got)
    assert {w: v[0] for w, v in got.items()} == counts
    # Every pair is looked at for the words that differ in few places of the list.
    some = sorted(counts)[::7]
    for w in some:
        near = [v for v in counts if one_edit(w, v)]
        assert got[w][1] == len(near)
    by_form = {w: v[2] for w, v in got.items()}
    for w, (n, _, form, form_n, root) in got.items():
        assert (form is None) == (form_n is None)
        if form is not None:
            assert one_edit(w, form) and form_n == counts[form] >= 2 * n
        at = w
        while by_form[at] is not None:
            at = by_form[at]
        assert at == root


def random_vocabulary(seed, n, letters, sizes):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        if words and rng.random() < 0.6:
            w = list(rng.choice(sorted(words)))
            kind, i = rng.randrange(3), rng.randrange(len(w))
            if kind == 0:
                w[i] = rng.choice(letters)
            elif kind == 1:
                del w[i]
            else:
                w.insert(i, rng.choice(letters))
            w = "".join(w)
        else:
            w = "".join(rng.choice(letters) for _ in range(rng.randrange(*sizes)))
        if 5 <= len(w):
            words.add(w)
    return {w: rng.randrange(3, 60) for w in sorted(words)}


@pytest.mark.parametrize("letters", ["ab", "abcdefghéÿ", "abcdefghijklmnopqrstuvwxyzÀà"])
def test_against_all_pairs(spark, monkeypatch, letters):
    """Small blocks and leaves, so that words are near across them; with two
    letters most words have equal counts."""
    monkeypatch.setattr(S, "BLOCK", 20)
    monkeypatch.setattr(S, "LEAST", 2)
    monkeypatch.setattr(S, "LEAF", 3)
    monkeypatch.setattr(S, "QUERIES", 7)
    counts = random_vocabulary(5, 400, letters, (5, 12))
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found(S.variants(df)) == brute(counts)
    pairs = [tuple(sorted((r.a, r.b))) for r in S.near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))  # every pair once


def test_chains_of_forms(spark):
    counts = {"aaaaaaaa"[: 8 - i] + "bbbbbbbb"[:i]: 3 * 2**i for i in range(9)}  # each is the next one's variant
    counts["zzzzz"] = 4
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = found(S.variants(df))
    assert got == brute(counts)
    assert got["aaaaaaaa"][4] == "bbbbbbbb" and got["zzzzz"] == (4, 0, None, None, "zzzzz")


def test_ties_go_to_the_first_word(spark):
    counts = {"house": 3, "mouse": 9, "hours": 9, "hoose": 9}
    got = found(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got["house"][2] == "hoose" == brute(counts)["house"][2]


def test_odd_rows(spark, make_docs, odd_rows):
    text = "Straße straße STRAßE Straßen École école École naïve Ānaive x×y÷z 中straße文"
    rows = [*odd_rows, (21, text), (22, text), (None, text), (23, "ABCDEFG" * 30_000), (24, "abcdefg " * 5000)]
    df = make_docs(rows)
    got = {r.word: r.n for r in S.vocabulary(df, "doc_id", "text").collect()}
    assert got == brute_counts(rows) and "straße" in got
    assert S.variants(S.vocabulary(df, "doc_id", "text")).count() == len(got)
    empty = S.variants(S.vocabulary(df.limit(0), "doc_id", "text"))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (0, 1, 2, 63, 64, 65, 66, 300, 5, 5)]
    buf = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(words))], np.uint32)
    got = S.crc_spans(buf, end - [len(w) for w in words], end, seeds)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + w) for i, w in enumerate(words)]


def test_runs_of_letters():
    texts = ["", "AbÀÿ zĀy", "1a2b", "×", "a", "", "é", "中ab文"]
    buf, start, end, text, letters = S.find_runs(pa.array(texts))
    got = [(int(t), buf[a:b].tobytes().decode(), int(n)) for a, b, t, n in zip(start, end, text, letters, strict=True)]
    want = [(i, r.translate(LOWER), len(r)) for i, x in enumerate(texts) for r in RUN.findall(x)]
    assert got == want


def test_count_bits_bound_the_distance():
    """The bits' distance is never more than the letter counts' own."""
    rng = random.Random(7)
    words = ["".join(rng.choice("aabbccdé") for _ in range(9)).encode("latin-1") for _ in range(300)]
    bits = S.count_bits(S.matrix(words))
    counts = np.array([np.bincount(np.frombuffer(w, np.uint8), minlength=256) for w in words])
    for i in range(0, 300, 17):
        up = np.maximum(counts - counts[i], 0).sum(axis=1)
        assert (S.missing(bits, bits[i]) <= up).all()


def test_hot_document(spark, make_docs):
    """One word makes up a third of all runs, in many rows of one id."""
    rows = [(1, "common " * 500 + "commun cammon")] * 40 + [(i, "common other others") for i in range(100, 160)]
    df = make_docs(rows).repartition(8)
    counts = brute_counts(rows)
    assert found(S.variants(S.vocabulary(df, "doc_id", "text"))) == brute(counts)
    assert df.select(F.max("doc_id")).first()[0] == 159
