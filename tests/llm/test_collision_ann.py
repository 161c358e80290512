import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.llm import collision_ann as A
from tests.conftest import SF01


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        s = (x * x[i]).sum(axis=1)
        best = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in best]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for q, ranks in out.items():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
        out[q] = [ranks[i] for i in sorted(ranks)]
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


@pytest.mark.parametrize("kind", ["even", "norms", "clusters"])
def test_recall(spark, monkeypatch, kind):
    monkeypatch.setattr(A, "BLOCK", 700)
    monkeypatch.setattr(A, "QUERIES", 40)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 24)).astype(np.float32)
    if kind == "norms":
        x *= rng.lognormal(size=(2000, 1)).astype(np.float32)
    if kind == "clusters":
        x += 5 * rng.normal(size=(20, 24)).astype(np.float32)[rng.integers(0, 20, 2000)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(A.nearest(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0))
    want = brute(np.arange(2000), x.astype(np.float64), range(0, 2000, 20), 20)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    for q, g in got.items():
        for i, s in g:
            assert s == (x[i].astype(np.float64) * x[q].astype(np.float64)).sum()
        assert g == sorted(g, key=lambda r: (-r[1], r[0]))


def test_many_equal_vectors_go_by_id(spark):
    rows = [(i, [1.0, 2.0, -1.0]) for i in range(0, 400)] + [(1000 + i, [float(i), 1.0, 0.5]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = found(A.nearest(df, "vec_id", "embedding", F.col("vec_id") == 100))
    assert [i for i, _ in got[100]][:3] == [i for i, _ in brute(
        np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [100], 20)[100]][:3]
    same = [i for i, s in got[100] if s == 6.0]
    assert same == list(range(len(same)))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0], "a"),
        (20, [1.0, 0.0, 2.0], "a"),
        (21, [1.0, 1.0], "a"),
        (22, None, "a"),
        (40, [0.0, 0.0], "a"),
        (60, [nan, 1.0], "a"),
        (80, [inf, 1.0], "a"),
        (100, [None, 1.0], "a"),
        (120, [], "a"),
        (None, [5.0, 5.0], "a"),
        (23, [0.5, 0.0], "a"),
        (23, [0.5, 0.0], "b"),
        (24, [-1.0, 3.0], "a"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = found(A.nearest(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20))
    assert got == {0: [(21, 1.0), (23, 0.5), (24, -1.0)]}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert A.nearest(empty, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect() == []


def test_query_on_embeddings(spark):
    from lookout.llm.queries import op4

    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want = brute(ids, x, [int(i) for i in ids if i % 20 == 0], 20)
    got = found(op4(spark, SF01))
    assert set(got) == set(want) and recall(got, want) >= 0.9


def step_by_step(block, q, own, k):
    """Every step from the first, with full products of all that collided."""
    length, lines = np.sqrt((q**2).sum()), block.lines
    norm2 = (block.x**2).sum(axis=1)
    extra = np.sqrt(np.maximum(0.0, 1.0 - norm2 / block.reach**2))
    p = (block.x / block.reach) @ lines[:-1] + extra[:, None] * lines[-1]
    away = np.abs(p - (q / length) @ lines[:-1])
    value = (block.x * q).sum(axis=1)
    radius = A.RADII[0]
    while True:
        last = radius >= A.RADII[2]
        hits = (away <= radius).sum(axis=1)
        near = np.flatnonzero((last | (hits >= np.ceil(A.SHARE * lines.shape[1]))) & (block.ids != own))
        best = near[np.lexsort((block.ids[near], -value[near]))][:k]
        if last or (len(best) == k and np.sqrt(max(0.0, 2 - 2 * value[best[-1]] / (length * block.reach))) <= radius):
            return block.ids[best].tolist(), value[best].tolist()
        radius *= A.RADII[1]


@pytest.mark.parametrize("wide", [0, 8, 1 << 40])  # never, as set, always
def test_a_search_starts_where_the_last_one_ended(monkeypatch, wide):
    """The result is that of all steps in turn, in two or three steps a query."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x[:300] = x[300] + 0.05 * rng.normal(size=(300, 32))  # these end at early steps
    x[700:760] = x[699]
    block = A.Block(np.arange(1500), x)
    queries = [*range(800, 860), *range(5), 699, 300, 900, *range(10, 15)]
    monkeypatch.setattr(A, "WIDE", wide)
    looked, count = [], A.Block._hits
    monkeypatch.setattr(A.Block, "_hits", lambda self, *a: (looked.append(1), count(self, *a))[1])
    for i in queries:
        got = block.search(block.x[i], int(block.ids[i]), 20)
        assert (got[0].tolist(), got[1].tolist()) == step_by_step(block, block.x[i], int(block.ids[i]), 20)
    looked.clear()
    ends = set()
    for i in range(800, 860):
        block.search(block.x[i], int(block.ids[i]), 20)
        ends.add(block.step)
    assert len(looked) <= 3 * 60 and min(ends) >= 4
    few = A.Block(np.arange(5), x[:5])
    assert few.search(x[0], 0, 20)[0].tolist() == step_by_step(few, few.x[0], 0, 20)[0]
