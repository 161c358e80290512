"""Nearest neighbours by collision counting (operator 4).

Nearness is the largest inner product. Scaling all vectors of a block into
the unit ball and adding one coordinate turns this into nearest distance to
the query's direction, without changing the order.

*Index.* ``LINES`` random lines; each keeps all projections of a block in one
sorted array. *Search.* A query opens a window around its own projection on
every line; vectors inside collide with it. A vector that collides on ``SHARE``
of the lines is verified by its inner product with the query. Virtual rehashing
widens all windows step by step; the query ends with the first step at which its
k-th best is nearer than the half-width of the windows (a vector at just that
distance then collides on 68 % of the lines, a random one on fewer), or when the
windows are as wide as two points can be apart; then all are verified. What
ends a query at one step ends it at all wider ones, so the first such step is
looked for from the step of the query before, up or down. Narrow windows are read
off the sorted arrays; once they hold more than one in ``WIDE`` of all
projections, comparing all of them in a row counts the same and is faster.
Verified vectors are ordered by single-precision products; all that could be
among the ``k`` best by these get theirs on the original vectors in double
precision. Nothing is capped: a thousand equal vectors collide alike and are
all verified.

*Blocks.* Every vector is in one block of about ``BLOCK`` vectors; every
query visits every block, in groups of about ``QUERIES``, so each task holds
one block and one group. The best ``k`` of each block (at most
``k * blocks`` rows per query) are merged by rank.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors are compared with
vectors of the same length only; of rows with one id the smallest vector
counts; ties go to the smaller id; fewer candidates than ``k`` are all
returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import col, prepare

LINES = 48
SHARE = 0.62
BLOCK = 8192
QUERIES = 1024
# Half-widths of the windows, as distances in the unit ball: first, factor,
# last (a point and a direction are two apart at most).
RADII = (0.6, 1.15, 2.3)
# One in so many projections inside the windows makes them wide.
WIDE = 8


class Block:
    """Sorted projections of one block of vectors (rows of ``x``)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lines: int = LINES, seed: int = 11) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        norm2 = (self.x**2).sum(axis=1)
        self.reach = float(np.sqrt(norm2.max()))
        ball = self.x / self.reach
        extra = np.sqrt(np.maximum(0.0, 1.0 - norm2 / self.reach**2))
        self.lines = np.random.default_rng(seed).normal(size=(x.shape[1] + 1, lines))
        p = ball @ self.lines[:-1] + extra[:, None] * self.lines[-1]
        rank = np.argsort(p, axis=0)
        # All sorted arrays in one: line j's values are shifted by j * self.gap.
        widest = float(np.abs(p).max()) + float(np.sqrt((self.lines**2).sum(axis=0)).max())
        self.gap = 2.0 * (widest + RADII[2])
        shift = np.arange(lines) * self.gap
        self.values = (np.take_along_axis(p, rank, axis=0) + shift).T.reshape(-1)
        self.rank = np.ascontiguousarray(rank.T).reshape(-1)
        # For wide windows and first products, in single precision.
        self.rows, self.ball = np.ascontiguousarray(p.T, np.float32), ball.astype(np.float32)
        self.away, self.inside = np.empty_like(self.rows), np.empty(self.rows.shape, bool)  # filled by every query
        self.radii = [RADII[0]]
        while self.radii[-1] < RADII[2]:
            self.radii.append(self.radii[-1] * RADII[1])
        self.step = 0  # at which the last query ended
        self.blur = (x.shape[1] + 8) * float(np.finfo(np.float32).eps)  # bound of the products' error

    def _hits(self, middle: np.ndarray, radius: float, apart: bool) -> tuple[np.ndarray, bool]:
        """Lines on which each vector is in the window of this half-width, and
        whether ``away`` holds this query's distances (``apart``: before)."""
        m, n = self.rows.shape
        center = middle + np.arange(m) * self.gap
        lo, hi = np.searchsorted(self.values, center - radius), np.searchsorted(self.values, center + radius, side="right")
        if WIDE * int((hi - lo).sum()) <= n * m:
            inside = [self.rank[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
            return np.bincount(np.concatenate(inside), minlength=n), apart
        if not apart:
            np.subtract(self.rows, middle.astype(np.float32)[:, None], out=self.away)
            np.abs(self.away, out=self.away)
        np.less_equal(self.away, np.float32(radius), out=self.inside)
        return np.add.reduce(self.inside.view(np.uint8), axis=0, dtype=np.uint8 if m < 256 else np.int64), True

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, inner products) of the k nearest vectors found for ``q``
        other than the one with id ``own``, nearest first."""
        need = int(np.ceil(SHARE * self.lines.shape[1]))
        unit = q / float(np.sqrt((q**2).sum()))
        middle, short = unit @ self.lines[:-1], unit.astype(np.float32)
        other = self.ids != own
        verified, value = ~other, np.zeros(len(other), np.float32)
        apart = False

        def found(step: int) -> tuple[np.ndarray, float, bool]:
            """Vectors verified by then, the k-th best product, whether it ends here."""
            nonlocal apart
            last = step == len(self.radii) - 1
            if last:
                near = np.flatnonzero(other)
            else:
                hits, apart = self._hits(middle, self.radii[step], apart)
                near = np.flatnonzero((hits >= need) & other)
            new = near[~verified[near]]
            verified[new] = True
            value[new] = self.ball[new] @ short
            if len(near) < k:
                return near, -2.0, last
            kth = float(np.partition(value[near], len(near) - k)[len(near) - k])
            # |unit - ball|^2 = 2 - 2 <unit, ball>, for the k-th best
            return near, kth, last or np.sqrt(max(0.0, 2.0 - 2.0 * kth)) <= self.radii[step]

        near, kth, ends = found(self.step)
        if ends:
            while self.step:
                fewer, its, ends = found(self.step - 1)
                if not ends:
                    break
                self.step, near, kth = self.step - 1, fewer, its
        else:
            while not ends:
                self.step += 1
                near, kth, ends = found(self.step)
        near = near[value[near] >= kth - 2 * self.blur]
        exact = (self.x[near] * q).sum(axis=1)
        best = np.lexsort((self.ids[near], -exact))[:k]
        return self.ids[near][best], exact[best]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as a double-precision matrix."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy().astype(np.float64)
    return flat.reshape(len(lists), -1)


def _search_group(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        ids, scores, owners = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        if vectors.num_rows and queries.num_rows:
            block = Block(vectors.column("id").to_numpy(), _matrix(vectors.column("v")))
            for own, q in zip(queries.column("id").to_numpy(), _matrix(queries.column("v")), strict=True):
                i, s = block.search(q, own, k)
                ids.append(i)
                scores.append(s)
                owners.append(np.full(len(i), own))
        return pa.table(
            {
                "query_id": pa.array(np.concatenate(owners), pa.int64()),
                "vec_id": pa.array(np.concatenate(ids), pa.int64()),
                "score": pa.array(np.concatenate(scores), pa.float64()),
            }
        )

    return run


def nearest(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row
    where ``is_query`` holds, among all other rows."""
    prepare(df.sparkSession)
    v = col(vector_col)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (
        df.where(col(id_col).isNotNull() & v.isNotNull() & whole & F.exists(v, lambda c: c != 0))
        .select(col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("q"))
        .groupBy("id")
        .agg(F.min(F.struct("v", "q")).alias("r"))
        .select("id", "r.v", "r.q", F.size("r.v").alias("d"))
        .checkpoint()
    )
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    blocks, groups = -(-n // BLOCK) or 1, -(-n_queries // QUERIES) or 1
    draw = F.xxhash64("id", F.lit(5))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    vectors = rows.select("d", F.pmod(draw, F.lit(blocks)).alias("b"), every(groups).alias("g"), "id", "v")
    queries = rows.where("q").select("d", every(blocks).alias("b"), F.pmod(draw, F.lit(groups)).alias("g"), "id", "v")
    key = ["d", "b", "g"]
    found = vectors.groupBy(key).cogroup(queries.groupBy(key)).applyInArrow(
        _search_group(k), "query_id long, vec_id long, score double"
    )
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("i", "r")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("r.v").alias("vec_id"), (-F.col("r.s")).alias("score")
    )
