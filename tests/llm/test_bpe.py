import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Reference

from lookout.llm import bpe
from lookout.llm.queries import tokenizer_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.Tokenizer(f.read())


@pytest.fixture(scope="module")
def reference():
    t = Reference.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def same(own, reference, texts):
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(own.encode(t), np.int32) for t in texts]
    assert [g.tolist() for g in got] == want
    ends = np.concatenate([[0], np.cumsum([len(g) for g in got])])
    decoded = own.decode(np.concatenate(got), ends).to_pylist()
    assert decoded == reference.decode_batch(want, skip_special_tokens=False)


def test_random_texts(own, reference):
    rng = random.Random(2)
    letters = "aabbttthhheein's'' .,!é́̈ΣσİA\n\t\x1c\x85\xa0 12中文"
    odd = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "<|", "the", "ÄÖÜ", " ", "ﬁ"]
    texts = [
        "".join(rng.choice(odd) if rng.random() < 0.1 else rng.choice(letters) for _ in range(rng.randrange(40)))
        for _ in range(5000)
    ]
    same(own, reference, ["", " ", *texts])


def test_words_that_need_backtracking(own, reference):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[: rng.randrange(1, 27)]) for _ in range(60)) for _ in range(3000)]
    same(own, reference, [*texts, *["ab" * n for n in range(50)], *["a" * n for n in range(200)], "x" * 50_000])


def test_every_letter(own, reference):
    # Up to the letters that newer Unicode versions than Python's have added.
    texts = [c + "a" + c for c in map(chr, range(1, 0x800))]
    known = [t for t in texts if bpe.unicodedata.category(t[0]) != "Cn"]
    same(own, reference, known)


def test_bounded_tables(own, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    monkeypatch.setattr(bpe, "DECODED", 3)
    own.encode("a")
    own.cache.clear()
    own.words.clear()
    own.fits.clear()
    same(own, reference, ["the quick brown fox jumps over the lazy dog again and again"] * 3)


def test_unknown_steps_are_refused():
    import json

    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": None}, {"decoder": {"type": "ByteLevel"}}, {"model": {"type": "WordPiece"}}):
        with pytest.raises(ValueError):
            bpe.Tokenizer(json.dumps(spec | change))


def test_table_with_odd_rows(make_docs, odd_rows, reference):
    df = make_docs(odd_rows)
    both = bpe.decode(bpe.encode(df, "text", tokenizer_path()), "ids", tokenizer_path())
    assert set(df.columns) <= set(both.columns)
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in both.collect()), key=repr)
    ids = [reference.encode(t or "", add_special_tokens=False).ids for _, t in odd_rows]
    want = [(d, i, reference.decode(i, skip_special_tokens=False)) for (d, _), i in zip(odd_rows, ids, strict=True)]
    assert got == sorted(want, key=repr)
    at_once = bpe.encode_decode(df, "text", tokenizer_path())
    assert set(at_once.columns) == set(both.columns)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in at_once.collect()), key=repr) == got
    for add in (bpe.encode, bpe.encode_decode):
        assert add(make_docs([]), "text", tokenizer_path()).collect() == []


def test_decoding_null_and_unknown_ids(spark):
    df = spark.createDataFrame([(None,), ([],), ([320, None, -5, 999_999, 320],)], "ids array<int>")
    got = [r.decoded for r in bpe.decode(df, "ids", tokenizer_path()).collect()]
    assert got == ["", "", "a</w> a</w>"]


def test_query_on_documents(spark, reference):
    from lookout.llm.queries import op1

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for d, t in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.add((d, len(ids), sha(" ".join(map(str, ids))), sha(reference.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in op1(spark, SF001).collect()} == want


def test_walks_of_any_number_of_words(own, reference, monkeypatch):
    """Small walks, few slots for pairs and small pieces: the same ids."""
    from lookout.llm import bpe

    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzé中!#'"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))) for _ in range(20)) for _ in range(60)]
    texts += ["", " ", "<|startoftext|>a<|endoftext|> b", "x" * 300, "a\x1cb c"]
    for walked, slots, long in ((1, 2, 64), (7, 16, 5), (1000, 1 << 10, 400)):
        monkeypatch.setattr(bpe, "WALKED", walked)
        monkeypatch.setattr(bpe, "PAIR_SLOTS", slots)
        monkeypatch.setattr(bpe, "LONG", long)
        own.encode("a")
        own.cache.clear()
        own.words.clear()
        own.pair_keys, own.pair_fits = np.full(slots, -1, np.int64), np.zeros(slots, dtype=bool)
        same(own, reference, texts)
        assert [np.frombuffer(x, np.int32).tolist() for x in own.encode_many(texts)] == [
            np.frombuffer(own.encode(t), np.int32).tolist() for t in texts
        ]
    monkeypatch.undo()
    own.pair_keys, own.pair_fits = np.full(bpe.PAIR_SLOTS, -1, np.int64), np.zeros(bpe.PAIR_SLOTS, dtype=bool)
