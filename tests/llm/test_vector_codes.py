import hashlib

import duckdb
import numpy as np
import pytest

from lookout.llm import vector_codes as V
from lookout.llm.queries import op12
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def brute(rows, parts, entries, rounds):
    """Codes by comparing everything with everything in Python integers."""
    import math

    kept = [
        (i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    sizes = [len(v) for _, v, _ in kept]
    if not sizes:
        return {}, ""
    d = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    kept = [r for r in kept if len(r[1]) == d]
    w = d // parts
    first = {}
    for i, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    first = list(first.values())[:entries]
    books = [[v[p * w : (p + 1) * w] for v in first] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for _, v, _ in kept:
                part = v[p * w : (p + 1) * w]
                got.setdefault(near(p, part)[1], []).append(part)
            books[p] = [
                [sum(c) // len(got[k]) for c in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(books[p])
            ]
    out = []
    for i, v, lab in kept:
        found = [near(p, v[p * w : (p + 1) * w]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(s for s, _ in found), lab))
    text = ",".join(str(c) for p in books for e in p for c in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA).repartition(3)
    books = V.train(df, "vec_id", "embedding", **how)
    if books is None:
        return [], ""
    got = V.encode(df, "embedding", books)
    assert set(got.columns) == set(df.columns)
    return [(r.vec_id, r.code, r.error, r.label) for r in got.collect()], books.sha256()


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("scale", [1.0, 0.01, 200.0])
def test_against_all_pairs(spark, scale):
    rng = np.random.default_rng(int(scale * 100))
    rows = [(int(i), (rng.normal(size=8) * scale).tolist(), int(i) % 3) for i in rng.permutation(300)]
    for how in ({"parts": 4, "entries": 16, "rounds": 2}, {"parts": 2, "entries": 64, "rounds": 1}, {"parts": 8, "entries": 5, "rounds": 3}):
        got, sha = coded(spark, rows, **how)
        want, want_sha = brute(rows, how["parts"], how["entries"], how["rounds"])
        assert key(got) == key(want) and sha == want_sha


def test_equal_sums_and_equal_distances():
    """Entries on one diagonal have one sum, and a part between two of them
    the same distance to both: the lower index counts, wherever it is sorted."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        entries = rng.integers(-4, 5, (12, 3))
        parts = rng.integers(-5, 6, (50, 3))
        index, best = V.nearest_entries(parts, entries)
        d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (index == d.argmin(axis=1)).all()


def test_search_looks_at_few_entries(monkeypatch):
    """The bound ends a search long before all entries are seen."""
    rng = np.random.default_rng(6)
    entries, parts = rng.integers(-1000, 1000, (64, 4)), rng.integers(-1000, 1000, (500, 4))
    seen, real = [], np.ndarray.sum

    class Counted(np.ndarray):
        def sum(self, *a, **k):
            seen.append(len(self))
            return real(np.asarray(self), *a, **k)

    index, _ = V.nearest_entries(parts.view(Counted), entries)
    assert (index == ((parts[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(seen) < 500 * 64


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], 1), (5, [0.5, 2.0, 3.0, 4.0], None), (1, None, 1),
        (2, [1.0, None, 1.0, 1.0], 1), (3, [nan, 0.0, 0.0, 0.0], 2), (4, [0.0, inf, 0.0, 0.0], 2), (6, [], 2),
        (7, [1.0, 2.0], 2), (None, [0.0, 0.0, 0.0, 0.0], None), (8, [0.0, 0.0, 0.0, 0.0], None), (9, [-0.001, 0.0, 9.0, -7.5], 3),
    ]
    got, sha = coded(spark, rows, parts=2, entries=3, rounds=2)
    want, want_sha = brute(rows, 2, 3, 2)
    assert key(got) == key(want) and sha == want_sha and len(got) == 6
    assert coded(spark, [(1, None, 1)], parts=2) == ([], "")
    assert coded(spark, [], parts=2) == ([], "")
    assert coded(spark, [(None, [1.0, 1.0], 1)], parts=2) == ([], "")
    for bad in ([(1, [1.0, 2.0, 3.0], 1)], [(1, [1e30, 2.0], 1)]):
        with pytest.raises(ValueError):
            coded(spark, bad, parts=2)


def test_label_errors(spark):
    rows = [(i, 10 * i, None if i % 3 == 0 else i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, error long, label int")
    got = {r.vec_id: r.label_error for r in V.error_by_label(df, "label").collect()}
    total = {}
    for _, e, lab in rows:
        total[lab] = total.get(lab, 0) + e
    assert got == {i: total[lab] for i, _, lab in rows}


def test_query_on_whole_table(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF01}/embeddings.parquet'").fetchall()
    got = op12(spark, SF01)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    rows = got.collect()
    want, sha = brute(table, 16, 64, 2)
    assert sorted((r.vec_id, r.code, r.error) for r in rows) == sorted((i, c, e) for i, c, e, _ in want)
    assert {r.codebooks_sha256 for r in rows} == {sha}
