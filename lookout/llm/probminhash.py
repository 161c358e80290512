"""Near-duplicate documents by ProbMinHash (operator 7).

A text is the multiset of its word shingles (``shingle`` words; a text with
fewer words is one shingle), each weighted by how often it occurs. The
similarity of two texts is the probability Jaccard index of the weights,
``J_P = sum_d 1 / sum_e max(x_e / x_d, y_e / y_d)``, which is the Jaccard
index where no shingle repeats.

*Sketch.* Every shingle starts a Poisson process whose rate is its weight;
arrivals carry a random register, and a register keeps the shingle that
arrived first. Two texts agree in a register with probability J_P. All
shingles of a piece advance one arrival per round, and a shingle ends as soon
as its time is past the largest register of its text (early termination).

*Banding.* The registers are cut into bands; equal bands share a bucket.
Texts that are equal as a whole are one node from the start. Every member of
a bucket is paired with the bucket's smallest node. After these pairs are
verified and joined to components, buckets that still hold several components
are compared in blocks: pairs of different components whose sketches agree
enough are verified in place, and a block gives the links that join
components (others can't change a class).

*Verification.* J_P exactly, from the sorted shingle hashes (32 bits) and
counts of both texts; linked at ``threshold`` or more.

Classes are the components of the links. Defined cases: null is the empty
text; texts without words are linked only to equal texts; ``class_id`` is the
smallest id in the class (null ids come after all others); repeated rows and
ids are kept, one result row per input row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.components import components
from lookout.llm.frames import col, joinable, prepare, whole_text
from lookout.llm.words import U64, Powers, find_words, mix, pieces, range_hash, runs, spread

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 100
BANDS = 20
# Members of a block when a bucket is compared in itself.
BLOCK = 512
# Of registers that agree, for a pair of one block to be verified: 4.5
# standard deviations under the threshold.
LIKELY = 0.62
# Rows of (text hash, id) that are broadcast to find their texts, so that the
# other texts are not shuffled; a larger table is joined by a shuffle.
BROADCAST_NODES = 200_000

_SHINGLE = Powers(0xA24BAED4963EE407)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash, count) of the distinct shingles, sorted by both."""
    w = find_words(texts)
    per = w.counts()
    n = np.where(per >= size, per - size + 1, np.minimum(per, 1))
    start = spread(w.first[:-1], n)
    doc = np.repeat(np.arange(len(n)), n)
    end = start + np.minimum(per, size)[doc]
    value = mix(range_hash(w.hash, start, end, _SHINGLE))
    order = np.argsort(value)
    small = doc.astype(np.uint16) if len(n) < 65536 else doc
    order = order[np.argsort(small[order], kind="stable")]
    doc, value = doc[order], value[order]
    head = runs(doc, value)
    return doc[head], value[head], np.diff(np.append(head, len(value)))


def sketch(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (texts x m): the shingle that arrives first in
    each register. A text without shingles has zeros."""
    out = np.zeros((texts, m), dtype=U64)
    total = np.bincount(doc, weights=weight, minlength=texts)
    todo = total > 0
    horizon = np.where(todo, m * (np.log(m) + 3.0) / np.maximum(total, 1e-300), 0.0)
    while todo.any():
        flat = out.reshape(-1)
        first = np.full(texts * m, np.inf)
        limit = horizon.copy()
        live = np.flatnonzero(todo[doc])
        d, v, w = doc[live], value[live], weight[live].astype(np.float64)
        seed, t = mix(v ^ U64(0x9E3779B97F4A7C15)), np.zeros(len(live))
        step = 0
        while len(d):
            step += 1
            draw = mix(seed + U64(step * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF))
            t = t + -np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
            on = t < limit[d]
            d, v, w, seed, t, draw = d[on], v[on], w[on], seed[on], t[on], draw[on]
            at = d * m + (mix(draw) % U64(m)).astype(np.int64)
            new = np.flatnonzero(t < first[at])
            new = new[np.argsort(-t[new])]  # the last of equal registers is the earliest arrival
            first[at[new]] = t[new]
            flat[at[new]] = v[new]
            if step <= 8 or step % 16 == 0:
                limit = np.minimum(limit, first.reshape(texts, m).max(axis=1))
        todo &= ~np.isfinite(first.reshape(texts, m)).all(axis=1)
        horizon *= 2
    return out


def bands_of(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """Bucket of each band (texts x bands)."""
    rows = registers.shape[1] // bands
    r = registers[:, : rows * bands].reshape(len(registers), bands, rows)
    h = np.zeros(r.shape[:2], dtype=U64)
    for i in range(rows):
        h = mix(h * U64(0x9E3779B97F4A7C15) + r[:, :, i])
    return mix(h + np.arange(bands, dtype=U64))


def _lists(values: np.ndarray, length: int) -> pa.Array:
    """Rows of a matrix as int64 lists of one length."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * length
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).view(np.int64).reshape(-1)))


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values[ends[i]:ends[i + 1]]`` as binary values."""
    offsets = (ends * values.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _buckets(shingle: int, m: int, bands: int):
    """(id, node, text) -> (id, node, buckets)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                doc, value, count = shingles(piece.column(2), shingle)
                n = piece.num_rows
                buckets = _lists(bands_of(sketch(doc, value, count, n, m), bands), bands)
                some = np.bincount(doc, minlength=n) > 0
                if not some.all():
                    ends = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
                    flat = buckets.values.to_numpy().reshape(n, bands)[some].reshape(-1)
                    buckets = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.record_batch(
                    [piece.column(0), piece.column(1), buckets], names=["id", "node", "buckets"]
                )

    return run


def _contents(shingle: int, m: int):
    """(node, text) -> (node, sorted 32-bit shingles, their counts, sketch)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                n = piece.num_rows
                doc, value, count = shingles(piece.column(1), shingle)
                registers = (sketch(doc, value, count, n, m) >> U64(32)).astype(np.uint32)
                # Sorted by their upper halves already; equal halves become one.
                short = (value >> U64(32)).astype(np.uint32)
                head = runs(doc, short)
                total = np.add.reduceat(count, head) if len(head) else count
                ends = np.searchsorted(doc[head], np.arange(n + 1))
                yield pa.record_batch(
                    [
                        piece.column(0),
                        _bytes(short[head], ends),
                        _bytes(total.astype(np.uint32), ends),
                        _bytes(registers.reshape(-1), np.arange(n + 1) * m),
                    ],
                    names=["node", "keys", "counts", "registers"],
                )

    return run


def probability_jaccard(ka: np.ndarray, ca: np.ndarray, kb: np.ndarray, cb: np.ndarray) -> float:
    """J_P of two weighted sets given as sorted keys and their weights."""
    if not len(ka) or not len(kb):
        return 0.0
    at = np.minimum(np.searchsorted(ka, kb), len(ka) - 1)
    hit = ka[at] == kb
    x, y = ca[at[hit]].astype(np.float64), cb[hit].astype(np.float64)
    if not len(x):
        return 0.0
    only_x, only_y = float(ca.sum()) - x.sum(), float(cb.sum()) - y.sum()
    ratio, which = np.unique(x / y, return_inverse=True)
    xs, ys = np.bincount(which, weights=x), np.bincount(which, weights=y)
    above = xs[::-1].cumsum()[::-1] + only_x  # x of all whose ratio is as large
    below = ys.cumsum() - ys + only_y  # y of all whose ratio is smaller
    return float((1.0 / (above[which] / x + below[which] / y)).sum())


def _verified(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, *rest = batch.columns
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i, row in enumerate(zip(*rest, strict=True)):
                ka, ca, kb, cb = (np.frombuffer(x.as_buffer(), np.uint32) for x in row)
                linked[i] = probability_jaccard(ka, ca, kb, cb) >= threshold - 1e-9
            yield pa.record_batch([u, v], names=["u", "v"]).filter(pa.array(linked))

    return run


def _block_links(m: int, bands: int, likely: float, threshold: float):
    """Rows sorted by (bucket, i, j) -> links between different components. A
    group holds two blocks at most. A pair is looked at in the first band
    that it shares, and no more once its components are joined; so a group
    gives fewer links than it has members."""

    def links(rows: pa.Table) -> pa.RecordBatch | None:
        if rows.num_rows < 2:
            return None
        rows = rows.combine_chunks()
        block, band = rows.column("block").to_numpy(), rows.column("band")[0].as_py()
        lo, hi = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        root = np.arange(label.max() + 1)
        registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint32).reshape(-1, m)
        keys = [np.frombuffer(x, np.uint32) for x in rows.column("keys").to_pylist()]
        counts = [np.frombuffer(x, np.uint32) for x in rows.column("counts").to_pylist()]
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        u, v = [], []
        for a in left:
            others = right[right > a] if lo == hi else right
            others = others[root[label[others]] != root[label[a]]]
            same = registers[others] == registers[a]
            share = same.mean(axis=1)
            shared = same[:, : m // bands * bands].reshape(len(others), bands, m // bands).all(axis=2)
            here = np.flatnonzero((share >= likely) & (shared.argmax(axis=1) == band))
            for b in others[here[np.argsort(-share[here], kind="stable")]]:
                x, y = root[label[a]], root[label[b]]
                if x != y and probability_jaccard(keys[a], counts[a], keys[b], counts[b]) >= threshold - 1e-9:
                    root[root == y] = x
                    u.append(a)
                    v.append(b)
        node = rows.column("node").combine_chunks()
        return pa.record_batch([node.take(pa.array(u)), node.take(pa.array(v))], names=["u", "v"]) if u else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("bucket", "i", "j")]
            head = np.append(runs(*cols), batch.num_rows)
            for a, b in zip(head[:-1], head[1:], strict=True):
                k = tuple(c[a] for c in cols)
                if k != key and held:
                    found = links(pa.Table.from_batches(held))
                    held = []
                    if found is not None:
                        yield found
                key = k
                held.append(batch.slice(a, b - a))
        if held and (found := links(pa.Table.from_batches(held))) is not None:
            yield found

    return run


def _verify(pairs: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (u, v), those that are similar. The contents of v travel
    with the pair, those of u (often the same for many pairs) once."""
    c = contents.select("node", "keys", "counts")
    return (
        pairs.join(c.toDF("v", "kv", "cv"), "v")
        .join(c.toDF("u", "ku", "cu"), "u")
        .select("u", "v", "ku", "cu", "kv", "cv")
        .mapInArrow(_verified(threshold), "u binary, v binary")
    )


def near_duplicate_classes(
    df: DataFrame,
    id_col: str,
    text_col: str,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    registers: int = REGISTERS,
    bands: int = BANDS,
) -> DataFrame:
    """(id, node, class_id, class_node) per row: ``node`` stands for the
    whole text, ``class_id`` and ``class_node`` for its class."""
    prepare(df.sparkSession)
    rows = df.select(
        col(id_col).alias("id"),
        F.substring(F.unhex(F.sha2(whole_text(text_col), 256)), 1, 16).alias("node"),
        whole_text(text_col).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    rows_sketched = rows.mapInArrow(
        _buckets(shingle, registers, bands), f"id {kind}, node binary, buckets array<long>"
    ).checkpoint()
    nodes = rows_sketched.groupBy("node").agg(F.min("id").alias("id"), F.first("buckets").alias("buckets")).checkpoint()
    member = nodes.select("node", F.posexplode("buckets").alias("band", "bucket"))
    shared = member.groupBy("bucket").agg(F.min("node").alias("u"), F.count("*").alias("size")).where("size > 1")
    placed = member.join(shared, "bucket").checkpoint()  # only members of shared buckets
    pairs = placed.where("node <> u").select("u", F.col("node").alias("v")).distinct()
    wanted = placed.select(F.col("node").alias("n")).distinct().join(nodes, F.col("n") == nodes["node"])
    wanted = wanted.select("n", F.col("id").alias("i")).checkpoint()
    contents = (
        rows.join(
            joinable(wanted, BROADCAST_NODES),
            (rows["node"] == F.col("n")) & rows["id"].eqNullSafe(F.col("i")),
        )
        .groupBy("n", "i")
        .agg(F.first("text").alias("text"))
        .select(F.col("n").alias("node"), "text")
        .mapInArrow(
            _contents(shingle, registers), "node binary, keys binary, counts binary, registers binary"
        )
        .checkpoint()
    )
    links = _verify(pairs, contents, threshold).checkpoint()
    label = components(links).checkpoint()

    # Buckets of three and more that still hold several components.
    labelled = (
        placed.where("size > 2")
        .join(label, "node", "left")
        .select("bucket", "band", "node", "u", "size", F.coalesce("comp", "node").alias("label"))
        .checkpoint()
    )
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("label").alias("a"), F.max("label").alias("b"))
        .where("a <> b")
        .select("bucket")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    more = (
        labelled.join(mixed, "bucket")
        .where("node <> u")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "bucket",
            "band",
            F.least("block", "with").alias("i"),
            F.greatest("block", "with").alias("j"),
            "block",
            "node",
            "label",
        )
        .join(contents, "node")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(_block_links(registers, bands, LIKELY, threshold), "u binary, v binary")
        .checkpoint()
    )
    if not more.isEmpty():
        label = components(links.unionByName(more)).checkpoint()
    best = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    classes = label.join(nodes.select("node", "id"), "node")
    heads = classes.groupBy("comp").agg(F.min(best).alias("head"))
    moved = classes.join(heads, "comp").select("node", "head")
    own = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    by_node = (
        nodes.select("node", own.alias("own"))
        .join(moved, "node", "left")
        .select("node", F.coalesce("head", "own").alias("head"))
    )
    return (
        rows_sketched.select("id", "node")
        .join(by_node, "node")
        .select("id", "node", F.col("head.id").alias("class_id"), F.col("head.node").alias("class_node"))
    )


def keep_one(df: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """Rows of ``df`` with one row of each class left: that with the class's
    id and text (of repeated rows, one)."""
    found = near_duplicate_classes(df, id_col, text_col, **options).checkpoint()
    gone = found.where(~(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))))
    text = F.substring(F.unhex(F.sha2(whole_text(text_col), 256)), 1, 16)
    keyed = df.withColumn("_llm_node", text)
    gone = gone.select(F.col("id").alias("_llm_i"), F.col("node").alias("_llm_n")).distinct().checkpoint()
    stay = keyed.join(
        joinable(gone, BROADCAST_NODES),
        col(id_col).eqNullSafe(F.col("_llm_i")) & (F.col("_llm_node") == F.col("_llm_n")),
        "left_anti",
    )
    again = (
        found.where(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node")))
        .groupBy(F.col("id").alias("_llm_i"), F.col("node").alias("_llm_n"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .checkpoint()
    )
    if not again.isEmpty():  # rows repeated as a whole: one of each
        on = col(id_col).eqNullSafe(F.col("_llm_i")) & (F.col("_llm_node") == F.col("_llm_n"))
        one = stay.join(again, on, "left_semi").dropDuplicates([id_col, "_llm_node"])
        stay = stay.join(again, on, "left_anti").unionByName(one)
    return stay.select(*[col(c) for c in df.columns])
