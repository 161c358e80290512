"""Removal of long passages that repeat (operator 8): De Bruijn compaction.

The graph's edges are the token k-mers of every text (k = ``window`` tokens,
two edges meet in the k-1 tokens that they share). An edge that starts at two
or more places is repeated. The work:

1. *Edges, near their source.* Each task cuts its texts into k-mers with
   vectorised prefix hashes. Of the k-mers that repeat within the piece at
   hand only one goes on, marked as known (the pre-aggregation: a passage in
   a third of all texts leaves each piece once). Neighbouring k-mers share
   their *anchor*, the smallest ``ANCHOR``-token hash inside them, and travel
   in one row: anchor, source coordinate, and the whole hash of each k-mer.
2. *Repeated edges, by anchor.* Equal k-mers have equal anchors at equal
   offsets, so one shuffle on the anchor brings all places of a k-mer
   together. A k-mer is repeated only if anchor (64 bits), offset and the
   independent k-mer hash (64 bits) agree at two source coordinates.
   A partition is read in sorted order in bounded chunks; an anchor that
   spans chunks carries one row per distinct k-mer.
   *Hot anchors* (a header in a third of all texts) are split: windows are
   first counted by ``SLOTS`` classes of anchors, and the k-mers of an anchor
   in a class over the bound go by anchor and k-mer hash, each in a row of its
   own with a second independent hash of 64 bits, which is compared as well.
   Equal k-mers still meet, so the split loses nothing.
3. *Compaction, by source.* Repeated edges that follow each other at their
   source form a path without leaving it; each path is one span (start,
   number of edges), joined to its text by the source coordinate, where its
   words are removed.

Defined cases: a null text has no words; texts shorter than the window are
kept; repeated rows (same id and text) count as separate places, so their
windows are repeated; rows with one id and different texts are told apart by
a hash of the text; null ids are a value like any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text
from lookout.llm.words import U64, Powers, Words, find_words, mix, pieces, range_hash, runs, spread

WINDOW = 35
ANCHOR = 8
CODE_BYTES = 8
# K-mers of one chunk in step 2.
CHUNK_EDGES = 350_000
# Bytes of texts whose windows are counted at once (one text at least).
COUNTED = 1 << 20
# Classes of anchors; one is hot with more than HOT_EDGES windows, or more than
# one in HOT_SHARE of all.
SLOTS = 1 << 16
HOT_EDGES = 1 << 20
HOT_SHARE = 1000

_EDGE = Powers(0x9FB21C651E98DF25)
_SECOND = Powers(0xA24BAED4963EE407)
_ANCHOR = Powers(0xD6E8FEB86659FD93)


def sliding_min(v: np.ndarray, span: int) -> np.ndarray:
    """``out[i] = min(v[i : i + span])`` by doubling."""
    size = 1
    while 2 * size <= span:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = span - size
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def _windows(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of each window."""
    wins = np.maximum(w.counts() - (window - 1), 0)
    return spread(w.first[:-1], wins), np.repeat(np.arange(len(wins)), wins)


def _anchors(w: Words, pos: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the anchor of each window."""
    at = np.arange(len(w.hash) - anchor + 1)
    small = mix(range_hash(w.hash, at, at + anchor, _ANCHOR))
    # The anchor: smallest upper half of the hash, the leftmost of equals.
    best = sliding_min((small & U64(0xFFFFFFFF00000000)) | at.astype(U64), window - anchor + 1)
    where = (best[pos] & U64(0xFFFFFFFF)).astype(np.int64)
    return small[where], where


def _slot(bucket: np.ndarray) -> np.ndarray:
    return (bucket & U64(SLOTS - 1)).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Windows by class of anchors."""
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for piece in pieces(batch, 0, COUNTED):
            w = find_words(piece.column(0))
            pos, _ = _windows(w, window)
            if len(pos):
                total += np.bincount(_slot(_anchors(w, pos, window, anchor)[0]), minlength=SLOTS)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["slot", "n"])


def _hot_slots(texts: DataFrame, window: int, anchor: int) -> np.ndarray:
    """Whether a class of anchors is hot, by class; all windows are counted."""

    def count(batches):
        return _counted(batches, window, anchor)

    counts = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = counts.column("slot").to_numpy(), counts.column("n").to_numpy()
    hot = np.zeros(SLOTS, bool)
    hot[slot[n > min(HOT_EDGES, int(n.sum()) // HOT_SHARE)]] = True
    return hot


def _edge_rows(piece: pa.RecordBatch, window: int, anchor: int, hot: np.ndarray | None = None) -> pa.RecordBatch | None:
    """Step 1 for one piece of (id, h, text) rows; ``hot``: by class of anchors."""
    w = find_words(piece.column(2))
    pos, doc = _windows(w, window)
    if not len(pos):
        return None
    edge = mix(range_hash(w.hash, pos, pos + window, _EDGE))
    bucket, where = _anchors(w, pos, window, anchor)
    second = np.zeros(len(pos), U64)
    if hot is not None:
        split = np.flatnonzero(hot[_slot(bucket)])
        # other values of the words: sums of powers of odd bases share their low bits
        second[split] = mix(range_hash(mix(w.hash), pos[split], pos[split] + window, _SECOND))
        bucket[split] = mix(bucket[split] + mix(edge[split]))

    order = np.argsort(edge)
    begin = runs(edge[order], bucket[order], second[order])
    size = np.diff(np.append(begin, len(order)))
    known = np.zeros(len(order), dtype=bool)
    known[order[np.repeat(size > 1, size)]] = True
    first = np.zeros(len(order), dtype=bool)
    first[np.minimum.reduceat(order, begin)] = True

    def rows(index: np.ndarray, head: np.ndarray, codes: bool) -> tuple:
        n = np.diff(np.append(head, len(index)))
        lead = index[head]
        d = doc[lead]
        if codes:
            data = edge[index]
            ends = np.append(head, len(index)).astype(np.int32) * CODE_BYTES
            code = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            key = bucket[lead].view(np.int64)
        else:
            code = pa.nulls(len(head), pa.binary())
            key = mix(lead).view(np.int64)  # anywhere
        return key, d, pos[lead] - w.first[d], where[lead] - pos[lead], known[lead], code, n, second[lead].view(np.int64)

    sent = np.flatnonzero(first | ~known)
    a = rows(sent, runs(pos[sent] - np.arange(len(sent)), doc[sent], where[sent], known[sent], bucket[sent]), True)
    here = np.flatnonzero(known)
    b = rows(here, runs(pos[here] - np.arange(len(here)), doc[here]), False)
    both = [np.concatenate([x, y]) if isinstance(x, np.ndarray) else pa.concat_arrays([x, y]) for x, y in zip(a, b, strict=True)]
    key, d, start, rel, kn, code, n, second = both
    d = pa.array(d)
    return pa.record_batch(
        [
            pa.array(key),
            piece.column(0).take(d),
            piece.column(1).take(d),
            pa.array(start.astype(np.int32)),
            pa.array(rel.astype(np.int32)),
            pa.array(kn),
            code,
            pa.array(n.astype(np.int32)),
            pa.array(second),
        ],
        names=["bucket", "id", "h", "start", "rel", "known", "codes", "n", "second"],
    )


def _repeated(rows: pa.RecordBatch | pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
    """Step 2 for a chunk sorted by bucket: spans of newly found repeated
    edges, and what the last bucket carries into the next chunk."""
    table = pa.Table.from_batches([rows]) if isinstance(rows, pa.RecordBatch) else rows
    table = table.combine_chunks()
    get = lambda name: table.column(name).to_numpy()
    bucket, start, rel, known, n = get("bucket"), get("start"), get("rel"), get("known"), get("n")
    codes = table.column("codes").combine_chunks()
    _, offs, data = codes.buffers()
    offs = np.frombuffer(offs, np.int32)[codes.offset : codes.offset + len(codes) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]].reshape(-1, CODE_BYTES)
    code = np.frombuffer(raw.tobytes(), U64)

    row = np.repeat(np.arange(len(n)), n)
    step = spread(np.zeros(len(n), np.int64), n.astype(np.int64))
    offset = rel[row] - step
    of = bucket[row]
    second = get("second")[row]
    what = (of, code, offset, second)
    both = mix(of.view(U64)) + mix(code + mix(offset))
    order = np.argsort(both)
    begin = runs(*(x[order] for x in what))
    if len(begin) > len(runs(both[order])):  # different k-mers with one sum may lie mixed
        order = np.lexsort(what)
        begin = runs(*(x[order] for x in what))
    size = np.diff(np.append(begin, len(order)))
    told = np.logical_or.reduceat(known[row][order], begin) if len(begin) else np.zeros(0, bool)
    again = np.repeat((size > 1) | told, size)
    repeated = np.zeros(len(order), bool)
    repeated[order] = again

    new = np.flatnonzero(repeated & ~known[row])
    head = runs(new - np.arange(len(new)), row[new])
    lead = new[head]
    at = pa.array(row[lead])
    spans = pa.record_batch(
        [
            table.column("id").combine_chunks().take(at),
            table.column("h").combine_chunks().take(at),
            pa.array((start[row[lead]] + step[lead]).astype(np.int32)),
            pa.array(np.diff(np.append(head, len(new))).astype(np.int32)),
        ],
        names=["id", "h", "start", "n"],
    )
    if last or not len(bucket):
        return spans, None
    keep = np.sort(np.minimum.reduceat(order, begin))
    keep = keep[of[keep] == bucket[-1]]
    at = pa.array(row[keep])
    data = code[keep]
    ends = np.arange(len(keep) + 1, dtype=np.int32) * CODE_BYTES
    carry = pa.record_batch(
        [
            pa.array(of[keep]),
            table.column("id").combine_chunks().take(at),
            table.column("h").combine_chunks().take(at),
            pa.array((start[row[keep]] + step[keep]).astype(np.int32)),
            pa.array((rel[row[keep]] - step[keep]).astype(np.int32)),
            pa.array(repeated[keep]),
            pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
            pa.array(np.ones(len(keep), np.int32)),
            pa.array(second[keep]),
        ],
        names=rows.schema.names,
    )
    return spans, carry


def _spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    edges = 0
    for batch in batches:
        local = batch.filter(batch.column("codes").is_null())
        if local.num_rows:
            yield local.select(["id", "h", "start", "n"])
        batch = batch.filter(batch.column("codes").is_valid())
        at = 0
        while at < batch.num_rows:  # chunks of bounded numbers of edges
            total = np.cumsum(batch.column("n").to_numpy()[at:])
            take = max(1, int(np.searchsorted(total, CHUNK_EDGES - edges, side="right")))
            part = batch.slice(at, take)
            held.append(part)
            edges += int(total[part.num_rows - 1])
            at += part.num_rows
            if edges >= CHUNK_EDGES or at < batch.num_rows:
                spans, carry = _repeated(pa.Table.from_batches(held), last=False)
                yield spans
                held = [carry] if carry is not None and carry.num_rows else []
                edges = 0  # what is carried doesn't count: each chunk takes in new rows
    if held:
        yield _repeated(pa.Table.from_batches(held), last=True)[0]


def repeated_spans(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Spans of repeated windows of every text: ``id``, ``h`` (hash of the
    text, with ``id`` the source coordinate), ``start`` (word, from 0) and
    ``n`` (windows that start one after another from there)."""
    prepare(df.sparkSession)
    anchor = min(anchor, window)
    keyed = df.select(
        col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("h"), whole_text(text_col).alias("text")
    )
    kind = keyed.schema["id"].dataType.simpleString()
    hot = _hot_slots(keyed.select("text"), window, anchor)

    def cut(batches):
        for batch in batches:
            for piece in pieces(batch, 2):
                rows = _edge_rows(piece, window, anchor, hot)
                if rows is not None:
                    yield rows

    edges = keyed.mapInArrow(
        cut, f"bucket long, id {kind}, h long, start int, rel int, known boolean, codes binary, n int, second long"
    )
    return (
        edges.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_spans, f"id {kind}, h long, start int, n int")
    )


def remove_repeated(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``df`` with ``n_words``, ``n_removed`` and
    ``kept_text``: the words outside repeated windows, joined by one space."""
    spans = (
        repeated_spans(df, id_col, text_col, window)
        .groupBy(F.col("id").alias(OWN + "id"), F.col("h").alias(OWN + "h"))
        .agg(F.collect_set(F.struct("start", "n")).alias(OWN + "spans"))
    )

    @F.arrow_udf("n_words long, n_removed long, kept_text string")
    def keep(text: pa.Array, found: pa.Array) -> pa.Array:
        words, removed, kept = [], [], []
        for t, s in zip(text, found, strict=True):
            tokens = t.as_py().encode().split()
            words.append(len(tokens))
            if s.is_valid:
                mask = np.ones(len(tokens), bool)
                for span in s.as_py():
                    mask[span["start"] : span["start"] + span["n"] + window - 1] = False
                removed.append(len(tokens) - int(mask.sum()))
                tokens = compress(tokens, mask)
            else:
                removed.append(0)
            kept.append(b" ".join(tokens))
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["n_words", "n_removed", "kept_text"],
        )

    own = df.withColumn(OWN + "h", F.xxhash64(whole_text(text_col)))
    joined = own.join(
        spans, col(id_col).eqNullSafe(spans[OWN + "id"]) & (own[OWN + "h"] == spans[OWN + "h"]), "left"
    ).withColumn(OWN + "kept", keep(whole_text(text_col), F.col(OWN + "spans")))
    new = ["n_words", "n_removed", "kept_text"]
    return joined.select(
        *[col(c) for c in df.columns if c not in new], *[F.col(OWN + "kept")[c].alias(c) for c in new]
    )
