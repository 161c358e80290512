import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lookout.llm import words as W
from lookout.llm.lookup import HashIndex

TEXT = st.text(alphabet="aB é\n\t 中\x0b \x1c", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=12), st.integers(0, 3))
def test_words_are_those_of_the_pattern(texts, skip):
    arr = pa.array(["pad " * skip, *texts], pa.string()).slice(1)
    w = W.find_words(arr)
    got = [[bytes(w.buf[w.start[i] : w.end[i]]) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [[x.encode() for x in re.findall("[^\x20\x09-\x0d]+", t)] for t in texts]
    seen = {}
    for word, h in zip([x for t in got for x in t], w.hash.tolist(), strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_the_chunk(monkeypatch):
    texts = pa.array([" ".join(f"word{i}" for i in range(2000)), "Word1 word2", ""])
    whole = W.find_words(texts).hash
    monkeypatch.setattr(W, "HASH_CHUNK", 37)
    assert (W.find_words(texts).hash == whole).all()
    low = W.find_words(texts, lower=True)
    assert low.hash[-2] == low.hash[1]


def test_pieces_hold_every_row_once_and_stay_small():
    texts = ["a" * n for n in (0, 5, 30, 1, 1, 9, 0, 0, 12)]
    batch = pa.record_batch([pa.array(texts)], names=["t"])
    parts = list(W.pieces(batch, 0, limit=12))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 12 for p in parts)
    assert list(W.pieces(batch.slice(0, 0), 0)) == []


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_hash_index(keys, others):
    keys = sorted(keys)
    index = HashIndex(np.array(keys, np.uint64))
    want = {k: i for i, k in enumerate(keys)}
    probe = keys + others
    assert index.find(np.array(probe, np.uint64)).tolist() == [want.get(k, -1) for k in probe]
