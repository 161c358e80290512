import collections
import re

import pyarrow as pa
import pytest

from lookout.llm import rules as R
from tests.conftest import SF01

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c a b c a",
    "x y z\n x y z\nx y z\nx y z",
    "a a a a a",
    "é中 # $| <b>   \x1c w",
    "one\r\ntwo\r\none\r\n\n\n",
    " ".join(f"w{i % 1000}" for i in range(30_000)),
    "q" * 100_000,
]


def test_measurements():
    got = R.measured(pa.array([t or "" for t in TEXTS])).to_pylist()
    assert [tuple(g.values())[:5] for g in got] == [brute(t) for t in TEXTS]


def test_ledger_policies_and_ablations(make_docs):
    rows = list(enumerate(TEXTS * 2))
    df = make_docs(rows)
    book = R.ledger(df, "text")
    assert set(df.columns) <= set(book.columns)
    some = R.Policy("some", 3, ("few_words", "endless_word"))
    out = R.verdicts(book, [R.BASE, some]).collect()
    fails = {r.doc_id: {x.name for x in R.RULES if r.failed & R.BIT[x.name]} for r in out}
    for r in out:
        n, _, _, _, repeated = brute(dict(rows)[r.doc_id])
        assert ("few_words" in fails[r.doc_id]) == (n < 50)
        assert ("repeated_words" in fails[r.doc_id]) == (100 * repeated > 50 * n)
        assert r.kept_some_v3 == (not fails[r.doc_id] & set(some.rules))
    for r in R.ablations(book, [R.BASE, some, R.STRICT]).collect():
        policy = set(next(p for p in (R.BASE, some, R.STRICT) if p.name == r.policy).rules)
        each = fails.values()
        assert r.n_texts == len(rows)
        assert r.n_kept == sum(not f & policy for f in each)
        assert r.n_failed == sum(r.rule in f for f in each)
        assert r.n_only == sum(f & policy == {r.rule} for f in each)
        assert r.n_kept_without == sum(not f & (policy - {r.rule}) for f in each)


def test_empty_table(make_docs):
    book = R.ledger(make_docs([]), "text")
    assert book.collect() == [] and R.ablations(book, [R.BASE]).collect() == []


def test_masks_are_bits_in_order():
    assert list(R.BIT.values()) == [1 << i for i in range(len(R.RULES))]
    assert R.STRICT.mask == (1 << len(R.RULES)) - 1
    with pytest.raises(KeyError):
        _ = R.Policy("p", 1, ("no such rule",)).mask


def test_query_on_documents(spark):
    from lookout.llm.queries import op3

    docs = dict(tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect())
    good = {r.doc_id for r in spark.read.parquet(f"{SF01}/labels.parquet").where("quality = 1").collect()}
    got = op3(spark, SF01).collect()
    assert len(got) == len(docs)
    lost = 0
    for r in got:
        n, chars, symbols, dup, repeated = want = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)
        lost += r.doc_id in good and not r.base_failed and not r.kept
    assert lost == 0  # documents labelled good stay
