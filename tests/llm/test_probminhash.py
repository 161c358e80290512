import collections
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lookout.llm import probminhash as P
from lookout.llm.components import components
from tests.conftest import SF001


def weights(text, size=5):
    w = (text or "").encode().split()
    if len(w) < size:
        return collections.Counter([tuple(w)] if w else [])
    return collections.Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def slow_jp(a, b):
    both = set(a) | set(b)
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in both) for d in set(a) & set(b))


def brute(rows, threshold=0.8):
    """Class of each row: the smallest id connected to it (rows by index)."""
    sets = [weights(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if not same and sets[i] and sets[j]:
                n = len(set(sets[i]) & set(sets[j]))
                same = n and n / (len(sets[i]) + len(sets[j]) - n) > 0.3 and slow_jp(sets[i], sets[j]) >= threshold - 1e-9
            if same:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, least.get(find(i))) for i, (d, _) in enumerate(rows)]


@settings(max_examples=100, deadline=None)
@given(
    st.dictionaries(st.integers(0, 12), st.integers(1, 5), max_size=10),
    st.dictionaries(st.integers(0, 12), st.integers(1, 5), max_size=10),
)
def test_probability_jaccard(a, b):
    arr = lambda d, f: np.array(f(d), np.uint32)
    ka, kb = sorted(a), sorted(b)
    got = P.probability_jaccard(arr(ka, list), arr([a[k] for k in ka], list), arr(kb, list), arr([b[k] for k in kb], list))
    assert abs(got - slow_jp(collections.Counter(a), collections.Counter(b))) < 1e-9


def test_sketch_estimates_the_weighted_similarity():
    rng = random.Random(1)
    for _ in range(5):
        a = {rng.getrandbits(60): rng.choice([1, 1, 2, 7]) for _ in range(200)}
        b = {k: (v if rng.random() < 0.8 else rng.choice([1, 3, 9])) for k, v in a.items() if rng.random() < 0.9}
        b |= {rng.getrandbits(60): 1 for _ in range(10)}
        doc = np.array([0] * len(a) + [1] * len(b))
        value = np.array([*a, *b], np.uint64)
        s = P.sketch(doc, value, np.array([*a.values(), *b.values()]), 2, 4000)
        true = slow_jp(collections.Counter(a), collections.Counter(b))
        assert abs((s[0] == s[1]).mean() - true) < 4.5 * (true * (1 - true) / 4000) ** 0.5


def test_sketch_of_one_shingle_fills_all_registers():
    s = P.sketch(np.array([1]), np.array([99], np.uint64), np.array([3]), 3, 100)
    assert (s[1] == 99).all() and not s[0].any() and not s[2].any()


def test_short_texts_are_one_shingle():
    doc, value, count = P.shingles(pa.array(["", "a b", "a b", "a b c d e a b c d e a b c d e"]))
    assert doc.tolist()[:2] == [1, 2] and value[0] == value[1]
    assert sorted(count[2:]) == [2, 2, 2, 2, 3]


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"n{rng.random()}"
    return " ".join(words)


def test_against_brute_force(make_docs, odd_rows):
    rng = random.Random(3)
    rows = list(odd_rows)
    for group in range(12):
        base = [f"{rng.choice('abcdef')}{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))]
        for i in range(rng.randrange(1, 9)):
            rows.append((1000 * group + 20 + i, near(rng, base, rng.randrange(0, 4))))
    rows += [(50_000 + i, "To " * 50 + near(rng, ["q"] * 20, 1)) for i in range(4)]
    rng.shuffle(rows)
    found = P.near_duplicate_classes(make_docs(rows).repartition(4), "doc_id", "text")
    got = [(r.id, r.class_id) for r in found.collect()]
    assert collections.Counter(got) == collections.Counter(brute(rows))


def test_links_that_no_pivot_has(make_docs, monkeypatch):
    """A chain in which neighbours are similar and ends are not is one class,
    also when a bucket is compared in small blocks."""
    monkeypatch.setattr(P, "BLOCK", 2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12 : i * 12 + 250])) for i in range(12)]
    got = {r.id: r.class_id for r in P.near_duplicate_classes(make_docs(rows), "doc_id", "text").collect()}
    assert got == dict(brute(rows)) and set(got.values()) == {0}


def test_keep_one(make_docs, odd_rows):
    rows = [*odd_rows, (9, "one two three"), (10, "u v w x y z")]
    kept = P.keep_one(make_docs(rows), "doc_id", "text")
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # empty: ids 1, 2, None -> 1; blanks; long; "one two three" of 5, 5, 6, 9 -> one row of 5
    assert [d for d, _ in got if d is not None] == [1, 10, 3, 4, 5, 7, 8]
    assert [t for d, t in got if d is None] == ["alpha beta gamma"]
    assert kept.columns[:2] == ["doc_id", "text"] and "score" in kept.columns


def test_empty_table(make_docs):
    assert P.near_duplicate_classes(make_docs([]), "doc_id", "text").collect() == []
    assert P.keep_one(make_docs([]), "doc_id", "text").collect() == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 7), (5, 5), (3, 4), (4, 10), (10, 11), (2, 1)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 1, 11: 1, 7: 7, 8: 7, 9: 7}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_query_on_documents(spark):
    from lookout.llm.queries import op7

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op7(spark, SF001).collect()) == sorted(brute(rows))
