import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lookout.llm import backoff_lm as B
from lookout.llm.words import find_words
from tests.conftest import SF001

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def tokens(text):
    return [*(text or "").translate(LOW).encode().split(), None]


def unigram(rows, learnt):
    c = collections.Counter(w for d, t in rows if learnt(d) for w in tokens(t))
    total, distinct = sum(c.values()), len(c)
    return c, total, lambda w: math.log10((c[w] + 1) / (total + distinct + 1))


def check(rows, learnt, got):
    c, total, base = unigram(rows, learnt)
    want = sorted(((d, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), total, sum(map(base, tokens(t)))) for d, t in rows), key=repr)
    out = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    assert [w[:4] for w in sorted(want, key=lambda r: repr(r[:4]))] == [w[:4] for w in sorted(out, key=lambda r: repr(r[:4]))]
    assert sorted(w[4] for w in want) == pytest.approx(sorted(w[4] for w in out), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("vocabulary", [3, 50, 1 << 17])
def test_base_scores_are_exact_whatever_the_vocabulary(make_docs, odd_rows, vocabulary):
    rows = [*odd_rows, (20, "The the THE cat"), (21, "the dog"), (22, "unseen words here")]
    learnt = lambda d: d is not None and d < 22
    df = make_docs(rows).repartition(3)
    out = B.score(df, "doc_id", "text", F.coalesce(F.col("doc_id") < 22, F.lit(False)), vocabulary, 100)
    check(rows, learnt, out.collect())


def test_nothing_to_learn_from_and_empty_table(make_docs):
    df = make_docs([(1, "a b"), (2, None)])
    got = {r.doc_id: r for r in B.score(df, "doc_id", "text", F.lit(False)).collect()}
    assert got[1].train_tokens == 0 and got[1].n_known == 0 and got[2].n_tokens == 1
    assert got[1].base_score == 0.0
    assert B.score(make_docs([]), "doc_id", "text", F.lit(True)).collect() == []


def test_every_state_is_a_distribution(spark):
    """After any history of two tokens, the probabilities of all words, the
    end and one unknown word sum to one."""
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(list("abcdefgh"), 12, p=[0.4, 0.2, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model, _, total, distinct = B.train(df, 100, 60)  # fewer arcs than pairs and triples
    assert (model.pairs.at >= 0).sum() and (model.triples.at >= 0).sum()
    words = [*"abcdefgh"]
    unknown = 1 / (total + distinct + 1)
    for history in ("", "a", "b", "a b", "c a", "zz", "zz a", "a zz", "h h"):
        p = 0.0
        for w in words:
            t = B.tokens_of(pa.array([f"{history} {w}"]))
            p += 10 ** model.read(t)[1][-2]
        t = B.tokens_of(pa.array([history]))
        p += 10 ** model.read(t)[1][-1]
        word, out = model.read(B.tokens_of(pa.array([f"{history} neverseen"])))
        assert word[-2] == -1
        p += 10 ** out[-2] * unknown
        assert p == pytest.approx(1.0, abs=1e-9), history


def test_automaton_against_a_plain_backoff_model(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abcd"), 8)) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model, _, _, _ = B.train(df)
    uni, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for t in texts:
        w = ["<s>", *tokens(t)]
        uni.update(w)
        two.update(zip(w, w[1:]))
        three.update(zip(w, w[1:], w[2:]))
    del_s = {k: v for k, v in uni.items() if k != "<s>"}
    total, distinct = sum(del_s.values()), len(del_s)
    p1 = {w: (c + 1) / (total + distinct + 1) for w, c in del_s.items()}
    kept2 = {k: c for k, c in two.items() if c >= 2}
    kept3 = {k: c for k, c in three.items() if c >= 2 and k[:2] in kept2}

    def p2(h, w):
        if (h, w) in kept2:
            return (kept2[h, w] - 0.75) / uni[h]
        out = [x for x in p1 if (h, x) in kept2]
        return (1 - sum((kept2[h, x] - 0.75) / uni[h] for x in out)) / (1 - sum(p1[x] for x in out)) * p1[w]

    def p3(g, h, w):
        if (g, h) not in kept2:
            return p2(h, w)
        if (g, h, w) in kept3:
            return (kept3[g, h, w] - 0.75) / kept2[g, h]
        out = [x for x in p1 if (g, h, x) in kept3]
        rest = 1 - sum((kept3[g, h, x] - 0.75) / kept2[g, h] for x in out)
        return rest / (1 - sum(p2(h, x) for x in out)) * p2(h, w)

    for t in texts[:10]:
        w = ["<s>", *tokens(t)]
        want = [math.log10(p2(w[0], w[1]))] + [math.log10(p3(*w[i - 2 : i + 1])) for i in range(2, len(w))]
        assert model.read(B.tokens_of(pa.array([t])))[1].tolist() == pytest.approx(want)


def test_end_token_hash_is_no_word_of_the_documents(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("text").toArrow()
    assert B.END not in find_words(rows.column("text").combine_chunks(), lower=True).hash


def test_query_on_documents(spark):
    from lookout.llm.queries import op9

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = op9(spark, SF001).collect()
    out = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    check(rows, lambda d: not out(d), got)
    assert all(r.held_out == out(r.doc_id) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the model beats single words


@pytest.mark.parametrize("vocabulary,arcs", [(3, 4), (50, 20), (1 << 17, 1 << 19)])
def test_scores_use_every_repeated_n_gram_whatever_is_sent(spark, make_docs, vocabulary, arcs):
    """The scores are those of the automaton that nothing was cut from."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), 9, p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05]))) for i in range(60)]
    rows += [(60, "a b unseen c a b"), (61, ""), (62, None)]
    df = make_docs(rows).repartition(3)
    texts = df.where("doc_id < 60").select("text")
    model, _, total, distinct = B.train(texts)
    got = {r.doc_id: r.score for r in B.score(df, "doc_id", "text", F.col("doc_id") < 60, vocabulary, arcs).collect()}
    for d, t in rows:
        word, value = model.read(B.tokens_of(pa.array([t or ""])))
        want = value.sum() + (word < 0).sum() * -math.log10(total + distinct + 1)
        assert got[d] == pytest.approx(want, abs=1e-9), (d, t)


@pytest.mark.parametrize("group", [4, 1 << 19])
def test_repeated_n_grams_are_shuffled_in_packed_groups(spark, monkeypatch, group):
    """Counts of all pairs and triples that repeat, without a shuffled row per
    pair or triple."""
    monkeypatch.setattr(B, "GROUP", group)
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdefgh"), 7)) for _ in range(40)] + ["", "z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts, total, _, _ = B.count_words(df)
    hashes = lambda t: [B.START, *map(int, B.tokens_of(pa.array([t])).hash)]
    seen = collections.Counter(p for t in texts for p in zip(hashes(t), hashes(t)[1:]))
    words = spark.sparkContext.broadcast(B._marks(counts.where("n >= 2")))
    got = B._count_grams(df, 2, words, total)
    plan = got._jdf.queryExecution().toString()
    assert "hashpartitioning(g" in plan and "hashpartitioning(left" not in plan
    unsigned = lambda x: x & (1 << 64) - 1
    rows = {(unsigned(r.left), unsigned(r.right)): r.n for r in got.collect()}
    assert rows == {p: n for p, n in seen.items() if n >= 2}

    key = lambda p: int(B._joined(*(np.array([x], np.uint64) for x in p), 2)[0])
    kept = spark.createDataFrame([(B._signed(key(p)),) for p in rows], "key long")
    three = collections.Counter(
        (key(h[i : i + 2]), key(h[i + 1 : i + 3])) for h in map(hashes, texts) for i in range(len(h) - 2)
    )
    got = B._count_grams(df, 3, spark.sparkContext.broadcast(B._marks(kept)), total).collect()
    assert {(unsigned(r.left), unsigned(r.right)): r.n for r in got} == {p: n for p, n in three.items() if n >= 2}


@pytest.mark.parametrize("group,held", [(1 << 19, 1_000_000), (4, 10)])
def test_lookups_and_word_counts_are_shuffled_in_packed_groups(spark, monkeypatch, group, held):
    """Sums over all keys of every row, without a shuffled row per key; words
    counted alike."""
    monkeypatch.setattr(B, "GROUP", group)
    monkeypatch.setattr(B, "HELD", held)
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 1 << 63, 60))
    level = np.where(np.arange(len(keys)) % 3 == 0, 1, 2).astype(np.int8)
    base, weight = np.where(level == 1, -1.5, 0.0), rng.normal(size=len(keys))
    bits = B._bits(60)
    order = np.argsort(B._group_of(keys, bits), kind="stable")
    columns = [keys, level, np.ones(len(keys), np.int64), base, weight]
    packed = pa.Table.from_batches(B._by_group(B._group_of(keys, bits)[order], *(c[order] for c in columns)))
    table = spark.createDataFrame(packed)
    asked = {r: rng.choice(np.append(keys[::2], keys + 1), 25) for r in (0, 1, 1 << 33, 5)}
    asked[9] = keys[:0]
    rows = spark.createDataFrame([(r, k.tobytes()) for r, k in asked.items()], "row long, rest binary").repartition(3)
    got = collections.defaultdict(lambda: np.zeros(3))
    for part in range(B.PARTS):
        out = B._looked_up(rows, table, bits, part)
        assert "Generate" not in out._jdf.queryExecution().toString()
        for r in out.collect():
            got[r.row] += [r.low, r.more, r.found]
    at = {int(k): i for i, k in enumerate(keys)}
    for r, k in asked.items():
        hits = [at[int(x)] for x in k if int(x) in at]
        assert got[r].tolist() == pytest.approx([base[hits].sum(), weight[hits].sum(), (level[hits] == 1).sum()]), r

    texts = [" ".join(rng.choice([*"abcdefgh", *map(str, range(40))], 9)) for _ in range(30)] + [""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    out = B._count(df, lambda t: t.hash)
    plan = out._jdf.queryExecution().toString()
    assert "hashpartitioning(g" in plan and "hashpartitioning(key" not in plan
    want = collections.Counter(int(h) for h in B.tokens_of(pa.array(texts)).hash)
    rows = out.collect()
    assert {r.key & (1 << 64) - 1: r.n for r in rows} == want and len(rows) == len(want)


def test_index_finds_every_key_and_no_other():
    from lookout.llm.lookup import HashIndex

    keys = np.random.default_rng(1).integers(0, 1 << 40, 5000)
    keys = np.unique(keys)
    assert HashIndex(keys).find(np.append(keys, keys + (1 << 41))).tolist() == [*range(len(keys)), *[-1] * len(keys)]
    assert HashIndex(np.zeros(0, np.uint64)).find(keys).tolist() == [-1] * len(keys)
