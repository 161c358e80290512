import collections
import hashlib
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from lookout.llm import mixing as M
from lookout.llm import queries
from tests.conftest import SF01


def divide(budget, children):
    """Water filling by rounds: {child: (weight, capacity)} -> {child: tokens}."""
    out, open_ = {}, {c: v for c, v in children.items() if v[0] > 0}
    out |= {c: 0 for c in children if c not in open_}
    left = Fraction(budget)
    while open_:
        total = sum(w for w, _ in open_.values())
        level = left / total
        full = [c for c, (w, cap) in open_.items() if cap <= w * level]
        if not full:
            return out | {c: int(w * level) for c, (w, _) in open_.items()}
        for c in full:
            left -= open_[c][1]
            out[c] = open_.pop(c)[1]
    return out


def brute_budgets(leaves, weights, budget, epochs):
    """leaves: {path: tokens}; weights: one function of a path's node per level."""
    depth = len(next(iter(leaves)))
    cap = collections.Counter()
    for path, tokens in leaves.items():
        ok = all(weights[i](path[: i + 1]) > 0 for i in range(depth))
        for i in range(depth + 1):
            cap[path[:i]] += tokens * epochs if ok else 0
    share = {(): min(cap[()], sum(leaves.values()) if budget is None else budget)}
    for i in range(depth):
        groups = collections.defaultdict(set)
        for path in leaves:
            groups[path[:i]].add(path[: i + 1])
        for parent, children in groups.items():
            share |= divide(share[parent], {c: (weights[i](c), cap[c]) for c in children})
    return {p: share[p] for p in leaves}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("budget", [None, 0, 777, 10**9])
def test_budgets_against_rounds_of_filling(spark, seed, budget):
    rng = random.Random(seed)
    leaves = {
        (a, b, c): rng.choice([0, 1, 10, 1000, 5000])
        for a in ("x", None, "z")
        for b in ("en", "de")
        for c in ("s1", "s2", "s3")
        if rng.random() < 0.8
    }
    w = [{n: rng.choice([0, 1, 2, 5]) for n in names} for names in (("x", None, "z"), ("en", "de"), ("s1", "s2", "s3"))]
    df = spark.createDataFrame([(*p, t, 1) for p, t in leaves.items()], "a string, b string, c string, tokens long, docs long")

    def column(name, table):
        out = F.lit(0)
        for k, v in table.items():
            out = F.when(F.col(name).eqNullSafe(F.lit(k)), v).otherwise(out)
        return out

    got = M.leaf_budgets(df, ["a", "b", "c"], [column(n, t) for n, t in zip("abc", w)], budget, 3)
    want = brute_budgets(leaves, [lambda p, t=t: t[p[-1]] for t in w], budget, 3)
    assert {(r.a, r.b, r.c): r.budget for r in got.collect()} == want


def brute_mix(rows, weight, budget, epochs, seed=42):
    """rows: (id, node, tokens). Returns the counter of (id, node, epoch)."""
    tokens = collections.Counter()
    for _, node, n in rows:
        tokens[node,] += n or 0
    share = brute_budgets(tokens, [lambda p: weight(p[0])], budget, epochs)
    out = collections.Counter()
    for (node,), total in tokens.items():
        mine = [(d, n or 0) for d, x, n in rows if x == node]
        full, rest = divmod(share[node,], total) if total else (0, 0)
        key = lambda d: hashlib.md5(f"{seed}:{full}:{'' if d is None else d}".encode()).hexdigest()  # noqa: B023, E731
        by_key = collections.Counter()
        for d, n in mine:
            by_key[key(d)] += n
        taken, upto = set(), 0
        for k in sorted(by_key):
            upto += by_key[k]
            if upto <= rest and rest:
                taken.add(k)
        for d, _ in mine:
            for e in range(full + (key(d) in taken)):
                out[d, node, e] += 1
    return out


@pytest.mark.parametrize("limit", [50_000, 0])
@pytest.mark.parametrize("budget", [None, 5, 40_000])
def test_mix_against_brute_force(spark, monkeypatch, limit, budget):
    monkeypatch.setattr(M, "BROADCAST_LEAVES", limit)
    rng = random.Random(9)
    rows = [(i, rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([0, 1, 5, 300, None])) for i in range(600)]
    rows += [(7, "hot", 50), (7, "hot", 50), (None, "cold", 9), (None, "cold", 9), (5000, "none", 0)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, node string, len long, n string, rest string, epoch int")
    weight = {"hot": 1, "cold": 5, None: 2, "none": 4}
    expr = F.lit(2)
    for k, v in weight.items():
        expr = F.when(F.col("node").eqNullSafe(F.lit(k)), v).otherwise(expr)
    out = M.mix(df, "doc_id", F.col("len"), {"node": (F.col("node"), expr)}, budget, 3)
    got = collections.Counter((r.doc_id, r.node, r.epoch) for r in out.collect())
    assert got == brute_mix(rows, weight.get, budget, 3)
    assert out.columns == ["doc_id", "node", "len", "n", "rest", "epoch"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, node string, len long")
    out = M.mix(df, "doc_id", F.col("len"), {"node": (F.col("node"), F.lit(1))})
    assert out.collect() == []


def test_no_python_in_the_plan(spark):
    plan = queries.op5(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_on_documents(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    want = con.execute(queries.MIX_SQL).fetchall()
    got = queries.op5(spark, SF01)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "string", "string", "bigint", "int"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_the_root_budget_moves_no_leaf(spark):
    """The leaf table isn't gathered in one task for its sums."""
    nodes = spark.range(1000).selectExpr("id AS leaf", "id AS tokens", f"CAST(id * 3 AS DECIMAL(38,0)) AS {M.OWN}cap").repartition(4)
    for budget, want in ((None, 499500), (7, 7), (10**9, 3 * 499500)):
        got = M._with_root_budget(nodes, budget)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "BroadcastNestedLoopJoin" in plan
        assert {int(r[0]) for r in got.select(M.OWN + "b").collect()} == {want} and got.count() == 1000
