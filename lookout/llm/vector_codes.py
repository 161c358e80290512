"""Vector code compression (operator 12).

A vector of integers is cut into equal parts; each part position has a codebook
of a few entries, and a vector's code is the index of the nearest entry of
every part (squared Euclidean distance, ties to the lower index). Codebooks
start at given vectors and are moved to the mean of their parts, rounded down,
in each round.

*Equal-average search.* The entries of a codebook are sorted by the sum of
their components. By the Cauchy-Schwarz inequality the squared distance of a
part and an entry is at least the squared gap between their sums over the
number of components. So a search starts at the part's own sum, looks at the
entry whose sum is next nearest on either side, and ends when the squared gap
over the dimension strictly exceeds the best distance so far (at an equal
bound an entry of a lower index may still tie). All parts of a batch step
together; those that have ended drop out.

Everything is 64-bit integer arithmetic and so exact in any order of rows.
Each task adds up its parts per entry; the sums of all tasks meet in one row
per entry. What goes to the driver and back to the tasks is the codebooks
(parts x entries x components of a part), whatever the size of the table.

Defined cases: vectors that are null or hold null or non-finite components are
left out, and so are those whose length isn't the usual one (the most
frequent, of several the smallest). Rows without an id are coded, but start no
codebook entry; of several rows with one id the smallest vector does. With
fewer vectors than entries there are fewer entries; repeated vectors give
repeated entries, of which the first is used. An empty table gives an empty
result. A usual length that can't be cut into equal parts, and components too
large for exact 64-bit sums of squares, are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, joinable, prepare

# Vectors of an Arrow batch that are handled at once.
ROWS = 4096
# Sums by label up to which they are broadcast.
BROADCAST_LABELS = 100_000


class Codebooks(NamedTuple):
    """``entries[part, entry]`` are integer components; ``scale`` turns a
    vector's components into integers (floor of the product)."""

    entries: np.ndarray
    scale: int

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Hash of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each part's nearest entry by equal-average
    search."""
    n, width = parts.shape
    m = len(entries)
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, by_sum = sums[order], entries[order]
    own = parts.sum(axis=1)
    high = np.searchsorted(sums, own)
    low = high - 1
    far = np.int64(2**62)
    best, index = np.full(n, far), np.full(n, m, np.int64)
    todo = np.arange(n)
    while len(todo):
        lo, hi, s = low[todo], high[todo], own[todo]
        gap_low = np.where(lo >= 0, s - sums[np.maximum(lo, 0)], -1)
        gap_high = np.where(hi < m, sums[np.minimum(hi, m - 1)] - s, -1)
        down = (gap_low >= 0) & ((gap_high < 0) | (gap_low <= gap_high))
        gap = np.where(down, gap_low, gap_high)
        # Strictly more than the best distance: nothing further out can be as near.
        on = (gap >= 0) & (gap * gap <= np.where(best[todo] == far, far, best[todo] * width))
        todo, lo, hi, down = todo[on], lo[on], hi[on], down[on]
        at = np.where(down, lo, hi)
        distance = ((parts[todo] - by_sum[at]) ** 2).sum(axis=1)
        entry = order[at]
        better = (distance < best[todo]) | ((distance == best[todo]) & (entry < index[todo]))
        best[todo[better]], index[todo[better]] = distance[better], entry[better]
        low[todo[down]] -= 1
        high[todo[~down]] += 1
    return index, best


def _good(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )


def _integers(vectors: pa.Array, scale: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a whole vector of the usual length, and their integers."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usual = np.flatnonzero(lengths == dimension)
    flat = vectors.take(pa.array(usual)).flatten()
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(usual), dimension)
    whole = np.isfinite(x).all(axis=1)
    return usual[whole], np.floor(scale * x[whole]).astype(np.int64)


def _add_up(books: Codebooks):
    """One row (part, entry, n, sums) for each used entry of a task."""
    parts, m, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, m), np.int64), np.zeros((parts, m, width), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                _, x = _integers(batch.column(0).slice(i, ROWS), books.scale, books.dimension)
                for p in range(parts):
                    part = x[:, p * width : (p + 1) * width]
                    index, _ = nearest_entries(part, books.entries[p])
                    n[p] += np.bincount(index, minlength=m)
                    np.add.at(sums[p], index, part)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(n[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    return run


def train(
    df: DataFrame, id_col: str, vector_col: str, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> Codebooks | None:
    """Codebooks of ``parts`` positions with at most ``entries`` entries each:
    the vectors of the smallest ids, moved ``rounds`` times over all vectors.
    None where there is no vector to start from."""
    prepare(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), col(vector_col).alias("v")).where(_good(F.col("v")))
    largest = F.max(F.aggregate("v", F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c.cast("double")))))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), largest.alias("most"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return None
    dimension = usual.d
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components can't be cut into {parts} equal parts")
    width = dimension // parts
    # Sums of squared differences and squared gaps of sums stay below 2**62.
    if usual.most * scale + 1 >= (1 << 30) // max(1, width, int(np.ceil(np.sqrt(dimension)))):
        raise ValueError(f"components up to {usual.most} are too large for exact 64-bit arithmetic")

    rows = rows.where(F.size("v") == dimension)
    ids = rows.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries)
    first = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    if not first:
        return None
    x = np.floor(scale * np.array([r.v for r in first], np.float64)).astype(np.int64).reshape(len(first), dimension)
    books = Codebooks(np.ascontiguousarray(x.reshape(len(first), parts, width).transpose(1, 0, 2)), scale)
    for _ in range(rounds):
        books = _move(rows, books)
    return books


def _move(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each used entry at the mean of its parts, rounded down."""
    width = books.entries.shape[2]
    partial = rows.select("v").mapInArrow(_add_up(books), "part int, entry int, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    moved = books.entries.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
        moved[r.part, r.entry] = [int(r[f"s{j}"]) // r.n for j in range(width)]
    return books._replace(entries=moved)


HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _code_arrays(vectors: pa.Array, books: Codebooks) -> pa.Array:
    parts, m, width = books.entries.shape
    at, x = _integers(vectors, books.scale, books.dimension)
    index, error = np.zeros((len(at), parts), np.int64), np.zeros(len(at), np.int64)
    for p in range(parts):
        index[:, p], distance = nearest_entries(x[:, p * width : (p + 1) * width], books.entries[p])
        error += distance
    text = HEX[index].reshape(-1)
    ends = np.arange(len(at) + 1, dtype=np.int32) * 2 * parts
    codes = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(text)])
    where = np.full(len(vectors), -1, np.int64)
    where[at] = np.arange(len(at))
    take = pa.array(where, mask=where < 0)
    return pa.StructArray.from_arrays([codes.take(take), pa.array(error).take(take)], names=["code", "error"])


def encode(df: DataFrame, vector_col: str, books: Codebooks) -> DataFrame:
    """Rows with a vector that can be coded, with ``code`` (two hex digits for
    each part's index, in order) and ``error`` (squared distances summed over
    the parts)."""
    if books.entries.shape[1] > len(HEX):
        raise ValueError("codes have two hex digits for each part: 256 entries at most")
    prepare(df.sparkSession)

    @F.arrow_udf("code string, error long")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield pa.concat_arrays(
                [_code_arrays(vectors.slice(i, ROWS), books) for i in range(0, max(1, len(vectors)), ROWS)]
            )

    c = OWN + "coded"
    # What can be coded is told before the coding: a filter on codes would run it twice.
    usable = df.where(_good(col(vector_col)) & (F.size(col(vector_col)) == books.dimension))
    return (
        usable.withColumn(c, coded(col(vector_col)))
        .select(
            *[col(x) for x in df.columns if x not in ("code", "error")],
            F.col(c)["code"].alias("code"),
            F.col(c)["error"].alias("error"),
        )
    )


def error_by_label(coded: DataFrame, label_col: str, out: str = "label_error") -> DataFrame:
    """All rows and columns with ``out``: the errors of all rows of the same
    label added up (null labels together). Sums are combined before their
    shuffle, so a hot label is no large group."""
    coded = coded.checkpoint()
    label, total = OWN + "label", OWN + "total"
    sums = coded.groupBy(col(label_col).alias(label)).agg(F.sum("error").alias(total)).checkpoint()
    joined = coded.join(joinable(sums, BROADCAST_LABELS), col(label_col).eqNullSafe(F.col(label)), "left")
    return joined.select(*[col(x) for x in coded.columns if x != out], F.col(total).alias(out))
