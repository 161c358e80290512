"""Language-model scores by a weighted backoff automaton (operator 9).

Tokens are a text's words, A-Z lowered, and one end token. The model is an
absolute-discounting backoff model up to three tokens whose lowest level is
the add-one unigram distribution over the whole training vocabulary.

*Counts* cover all training rows and are gathered by Spark: single tokens,
then pairs, then triples, each combined per partition before its shuffle. An
n-gram can be frequent only if its parts are, so a bitmap of the frequent
parts (a fixed number of bits, marked by hash) keeps most of the others out
of the shuffle; marks that are there by chance let some pass, and the count
decides. *Automaton.* An n-gram seen ``LEAST`` times is a state, whatever the size of
the corpus; reading a token follows an arc, and where there is none the
failure arc to the state of the next shorter suffix, whose weight the state
carries. Arcs out of a state hold the discounted estimates, and failure
weights make every state's distribution sum to one. States and arcs are Spark
tables, fitted by joins, and one table of packed groups of keys in the end
(``gram_weights``).
*Scoring.* Parts of a kept n-gram are kept too. So the log probability of a
token is a sum of weights that belong to one n-gram each: its own estimate
and failure weight, and for every longer kept n-gram what its arc differs
from the failure path. Each text is read once; the weights of the most
frequent n-grams (``vocabulary`` words, ``arcs`` pairs and triples) are sent
to the executors, with a bitmap of all that there are; the other n-grams of a
row that are marked meet the table's in their group, a part of the groups at a
time.
What is sent only saves shuffling and changes no score. Tables are deleted and
shuffle files freed as soon as the next step stands.

``train`` gives a model of bounded size in one object, for small corpora.

Defined cases: a null or empty text is its end token; a null id counts as the
empty text for the split; no training rows give N = V = 0; repeated rows are
scored (and learnt from) each on its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import Tables, col, freeing_shuffles, prepare, whole_text
from lookout.llm.lookup import HashIndex
from lookout.llm.words import U64, find_words, mix, pieces, runs

END = 0x3C6EF372FE94F82B  # stands for the end token among the word hashes
VOCABULARY = 1 << 17
ARCS = 1 << 19
DISCOUNT = 0.75
START = 0x6A09E667F3BCC908  # stands for the start of a text as a history
# Occurrences that make a pair or triple an arc.
LEAST = 2
# Bits of a token index in the key of an arc (state << BITS | token).
BITS = 20
# Bits of a bitmap of keys, and parts of the keys that are joined in turn.
MARKS = 1 << 28
PARTS = 3
# Distinct keys held per task before counts are handed on, rows handed on at
# once, and bytes of texts counted at once.
HELD = 1_000_000
SENT = 100_000
COUNTED = 1 << 20
# Tokens per group of keys (a power of two of groups) and keys per part of a
# bitmap, as groups are counted and parts marked at once.
GROUP = 1 << 19
PART = 1 << 22
# Bits of the number of groups where the number of tokens isn't known yet.
GROUP_BITS = 12


class Tokens(NamedTuple):
    """Tokens of several texts: hash, index of the text, whether first."""

    hash: np.ndarray
    text: np.ndarray
    first: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    w = find_words(texts, lower=True)
    n = len(w.first) - 1
    total = len(w.hash) + n
    ends = w.first[1:] + np.arange(n)
    word = np.ones(total, bool)
    word[ends] = False
    out = np.full(total, END, U64)
    out[word] = w.hash
    text = np.repeat(np.arange(n), w.counts() + 1)
    first = np.zeros(total, bool)
    first[ends - w.counts()] = True
    return Tokens(out, text, first)



def _merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Rows (key, values.., n) of all parts with n added up by key. A column
    of the parts goes as soon as the merged one stands."""
    keys = np.concatenate([p.pop(0) for p in parts])
    order = np.argsort(keys)
    keys = keys[order]
    head = runs(keys)
    out, first = [keys[head]], order[head]
    del keys
    while len(parts[0]) > 1:
        out.append(np.concatenate([p.pop(0) for p in parts])[first])
    n = np.concatenate([p.pop(0) for p in parts])
    out.append(np.add.reduceat(n[order], head) if len(head) else n)
    return out


def _added_up(
    batches: Iterable[pa.RecordBatch], rows_of: Callable[[Tokens], list[np.ndarray]]
) -> Iterator[list[np.ndarray]]:
    """Rows (key, values.., n) of all tokens of a task, added up by key as far
    as it holds them."""
    parts, size = [], 0
    for batch in batches:
        for piece in pieces(batch, 0, COUNTED):
            rows = rows_of(tokens_of(piece.column(0)))
            parts.append(_merged([[*rows, np.ones(len(rows[0]), np.int64)]]))
            size += len(parts[-1][0])
            if size > HELD:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield parts.pop()
                    size = 0
    if parts:
        yield _merged(parts)


def _count(texts: DataFrame, keys_of: Callable[[Tokens], np.ndarray]) -> DataFrame:
    """Counts (key, n) of all tokens' keys: added up per task, then per group
    of keys. A task reads its groups one after the other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in _added_up(batches, lambda t: [keys_of(t)]):
            yield from _by_group(_group_of(mix(key), GROUP_BITS), key.view(np.int64), n)

    def counted(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, n = _merged(parts)
        yield pa.record_batch([pa.array(key), pa.array(n)], names=["key", "n"])

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, size, least = None, [], 0, HELD
        for g, columns in _in_runs(batches, [np.int64, np.int64], "g"):
            if g != group and parts:
                yield from counted(parts)
                parts, size, least = [], 0, HELD
            group = g
            parts.append(columns)
            size += len(columns[0])
            if size > least:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                least = max(HELD, 2 * size)
        if parts:
            yield from counted(parts)

    packed = texts.mapInArrow(run, "g long, x0 binary, x1 binary")
    return packed.repartition("g").sortWithinPartitions("g").mapInArrow(add_up, "key long, n long")


def _bits(total: int) -> int:
    """Bits of the number of groups that ``total`` tokens need."""
    return max(0, total // GROUP).bit_length()


def _group_of(key: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of a key that is a hash."""
    if not bits:
        return np.zeros(len(key), np.uint16)
    return (key.view(U64) >> U64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)


def _by_group(group: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``_packed`` rows in whatever order."""
    order = np.argsort(group, kind="stable")
    yield from _packed(group[order].astype(np.int64), *(c[order] for c in columns))


def _held(rows: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Rows of a task, about half of ``HELD`` at once."""
    parts, size = [], 0
    for columns in rows:
        parts.append(columns)
        size += len(columns[0])
        if size >= HELD // 2:
            yield [np.concatenate(c) for c in zip(*parts, strict=True)]
            parts, size = [], 0
    if size:
        yield [np.concatenate(c) for c in zip(*parts, strict=True)]


def _values(column: pa.Array, first: int, end: int, dtype: type) -> np.ndarray:
    """Values that the rows ``first`` to ``end`` of a binary column hold."""
    if first == end:
        return np.zeros(0, dtype)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset + np.array([first, end])]
    return np.frombuffer(data, np.uint8)[at[0] : at[1]].view(dtype) if data is not None else np.zeros(0, dtype)


def _in_runs(
    batches: Iterable[pa.RecordBatch], dtypes: list[type], *same: str
) -> Iterator[tuple[int | tuple, list[np.ndarray]]]:
    """(value or values of the columns ``same``, values of x0, x1, ..) of runs
    of packed rows, which ascend by ``same``."""
    for batch in batches:
        of = [batch.column(c).to_numpy() for c in same]
        first = runs(*of)
        for i, j in zip(first, [*first[1:], batch.num_rows], strict=False):
            values = [_values(batch.column(f"x{k}"), i, j, d) for k, d in enumerate(dtypes)]
            yield (int(of[0][i]) if len(of) == 1 else tuple(int(c[i]) for c in of)), values


def _packed(group: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with ascending ``group``, as rows (g, x0, x1, ..) of bytes, one for
    every group: that many times fewer rows to shuffle."""
    for i in range(0, len(group), SENT):
        first = runs(group[i : i + SENT])
        ends = np.append(first, len(group[i : i + SENT]))
        packed = []
        for c in columns:
            offsets = pa.py_buffer((ends * c.itemsize).astype(np.int32))
            packed.append(pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(c[i : i + SENT])]))
        yield pa.record_batch([pa.array(group[i + first]), *packed], names=["g", *(f"x{k}" for k in range(len(columns)))])


def _unpacked(table: pa.Table, name: str, dtype: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in table.column(name)])


def _count_repeated(
    texts: DataFrame, rows_of: Callable[[Tokens], list[np.ndarray]], level: int, total: int
) -> DataFrame:
    """(left, right, n) of the rows (key, left, right) of all tokens that come
    ``LEAST`` times: added up per task, then per group of keys. There are as
    many groups as the ``total`` tokens need, so none grows with the corpus."""
    bits = _bits(total)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, left, right, n in _added_up(batches, rows_of):
            yield from _packed(_group_of(key, bits).astype(np.int64), left, right, n.astype(np.int32))

    def add_up(table: pa.Table) -> pa.Table:
        left, right, n = _unpacked(table, "x0", U64), _unpacked(table, "x1", U64), _unpacked(table, "x2", np.int32)
        _, left, right, n = _merged([[_joined(left, right, level), left, right, n.astype(np.int64)]])
        often = n >= LEAST
        return pa.table({"left": left[often].view(np.int64), "right": right[often].view(np.int64), "n": n[often]})

    packed = texts.mapInArrow(run, "g long, x0 binary, x1 binary, x2 binary")
    return packed.groupBy("g").applyInArrow(add_up, "left long, right long, n long")


def pairs_of(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, left part, right part) of the pair that ends at each token. The
    parts of a pair are words, those of a triple are pairs."""
    left = np.empty_like(t.hash)
    left[1:] = t.hash[:-1]
    left[t.first] = START
    return _joined(left, t.hash, 2), left, t.hash


def _joined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    return mix(mix(left + U64(level)) + right)


class Marks:
    """A bitmap of keys: what isn't marked isn't there."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        slot = _slot_of(keys)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) != 0


def _slot_of(keys: np.ndarray) -> np.ndarray:
    """The first bits of a key, which is a hash already."""
    return (keys.view(U64) >> U64(64 - MARKS.bit_length() + 1)).astype(np.int64)


def _marks(keys: DataFrame) -> Marks:
    """Bitmap of the column ``key`` (packed or not): every task packs the bits of its keys by
    part of the bitmap, and every part is put together in one group, whose
    size the bitmap bounds. The driver gets ``MARKS`` bits."""

    def out(slots: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        slot = np.unique(np.concatenate(slots))
        yield from _packed(slot // PART, (slot % PART).astype(np.int32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, size = [], 0
        for batch in batches:
            key = batch.column(0)
            packed = pa.types.is_binary(key.type)
            slots.append(_slot_of(_values(key, 0, len(key), np.int64) if packed else key.to_numpy()))
            size += len(slots[-1])
            if size > HELD:
                yield from out(slots)
                slots, size = [], 0
        if slots:
            yield from out(slots)

    def put_together(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PART, bool)
        for batch in batches:
            for x in batch.column("x0"):
                seen[np.frombuffer(x.as_buffer(), np.int32)] = True
        bits = np.packbits(seen, bitorder="little").tobytes()
        yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([bits])], names=["g", "bits"])

    packed = keys.select("key").mapInArrow(run, "g long, x0 binary")
    bits = np.zeros(-(-MARKS // PART) * PART // 8, np.uint8)
    table = packed.groupBy("g").applyInArrow(put_together, "g long, bits binary").toArrow()
    for g, part in zip(table.column("g").to_pylist(), table.column("bits"), strict=True):
        bits[g * (PART // 8) :][: PART // 8] = np.frombuffer(part.as_buffer(), np.uint8)
    return Marks(bits)


def _count_grams(texts: DataFrame, level: int, frequent, total: int) -> DataFrame:
    """(left, right, n) of the pairs or triples that are arcs. ``frequent``:
    broadcast bitmap of the words or pairs that are seen ``LEAST`` times."""

    def pairs(t: Tokens) -> list[np.ndarray]:
        key, left, right = pairs_of(t)
        marked = frequent.value.may_have(t.hash)
        may = marked.copy()
        may[1:] &= marked[:-1] | t.first[1:]
        return [key[may], left[may], right[may]]

    def triples(t: Tokens) -> list[np.ndarray]:
        pair = pairs_of(t)[0]
        here = _both(frequent.value.may_have(pair), t)
        left, right = pair[here - 1], pair[here]
        return [_joined(left, right, 3), left, right]

    return _count_repeated(texts, pairs if level == 2 else triples, level, total)


def _both(pairs: np.ndarray, t: Tokens) -> np.ndarray:
    """Tokens at which a triple ends whose parts are among ``pairs`` (by the
    token at which they end)."""
    may = np.zeros(len(pairs), bool)
    may[1:] = pairs[1:] & pairs[:-1] & ~t.first[1:]
    return np.flatnonzero(may)


def _key(level: int) -> Column:
    @F.arrow_udf("long")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(_joined(left.to_numpy().view(U64), right.to_numpy().view(U64), level).view(np.int64))

    return of("left", "right")


def _signed(x: int) -> int:
    return int(np.array([x], U64).view(np.int64)[0])


def _unique(df: DataFrame) -> DataFrame:
    """A table with one row per key as the side of a join that a hash table is
    made of: no key is large there, and neither side has to be sorted."""
    return df.hint("shuffle_hash")


def _histories(arcs: DataFrame, counts: DataFrame) -> DataFrame:
    """(left, hist, fail): count and failure weight of every history that has
    arcs. ``arcs``: left, n, and ``low``, the estimate without the history;
    ``counts``: left, hist."""
    sums = arcs.groupBy("left").agg(F.sum("n").alias("n"), F.count("*").alias("arcs"), F.sum("low").alias("under"))
    rest = lambda x: F.greatest(F.lit(1e-12), F.least(F.lit(1.0), 1 - x))
    taken = (F.col("n") - DISCOUNT * F.col("arcs")) / F.col("hist")
    fail = F.log10(rest(taken) / rest(F.col("under")))
    return sums.join(counts, "left").select("left", "hist", fail.alias("fail"))


def gram_weights(
    tables: Tables, texts: DataFrame, counts: DataFrame, total: int, distinct: int, rows: int
) -> tuple[DataFrame, float]:
    """(key, level, n, base, weight) of all words and of all pairs and triples
    that are arcs, in packed groups of keys, and the failure weight of the
    start. ``base`` is a word's unigram estimate (0 for others, which no word's
    is); a text's score is the sum of the weights of its n-grams and of the
    start."""
    spark = texts.sparkSession
    log_p = F.log10((F.col("n") - DISCOUNT) / F.col("hist"))
    words = counts.withColumn("p", (F.col("n") + 1.0) / (total + distinct + 1.0))
    begin = spark.createDataFrame([(_signed(START), rows)], "left long, hist long")

    def counted(level: int, keys: DataFrame) -> DataFrame:
        frequent = spark.sparkContext.broadcast(_marks(keys.where(F.col("n") >= LEAST)))
        found = tables.keep(_count_grams(texts, level, frequent, total))
        frequent.destroy()
        return found

    seen = counted(2, counts)
    often = words.where(F.col("n") >= LEAST)  # as the parts of an arc are
    known = tables.keep(seen.join(_unique(often.select(F.col("key").alias("right"), F.col("p").alias("low"))), "right"))
    tables.drop(seen)
    after_word = tables.keep(
        _histories(known, often.select(F.col("key").alias("left"), F.col("n").alias("hist")).union(begin))
    )
    pairs = tables.keep(
        known.join(_unique(after_word), "left").select(
            _key(2).alias("key"), "n", log_p.alias("log_p"), (log_p - F.col("fail") - F.log10("low")).alias("more")
        )
    )
    tables.drop(known)
    seen = counted(3, pairs)
    lower = pairs.select(F.col("key").alias("right"), F.pow(F.lit(10.0), "log_p").alias("low"))
    known = tables.keep(seen.join(_unique(lower), "right"))
    tables.drop(seen)
    # A triple whose first pair is marked by chance has no history.
    after_pair = tables.keep(_histories(known, pairs.select(F.col("key").alias("left"), F.col("n").alias("hist"))))
    fail = lambda t: t.select(F.col("left").alias("key"), "fail")
    more = F.coalesce("fail", F.lit(0.0))
    none = F.lit(0.0).alias("base")
    base = F.log10("p")
    no = F.lit(0).cast("long").alias("right")
    level = lambda k: F.lit(k).cast("byte").alias("level")
    table = (
        words.join(_unique(fail(after_word)), "key", "left")
        .select(F.col("key").alias("left"), no, level(1), "n", base.alias("base"), (base + more).alias("weight"))
        .union(
            pairs.join(_unique(fail(after_pair)), "key", "left").select(
                F.col("key").alias("left"), no, level(2), "n", none, (F.col("more") + more).alias("weight")
            )
        )
        .union(
            known.join(_unique(after_pair), "left").select(
                "left", "right", level(3), "n", none, (log_p - F.col("fail") - F.log10("low")).alias("weight")
            )
        )
    )
    bits = _bits(total)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, right, level, *values in _held([c.to_numpy() for c in b.columns] for b in batches):
            three = level == 3  # a triple has no key yet
            key[three] = _joined(key[three].view(U64), right[three].view(U64), 3).view(np.int64)
            yield from _by_group(_group_of(key, bits), key, level, *values)

    table = tables.keep(table.mapInArrow(pack, "g long, x0 binary, x1 binary, x2 binary, x3 binary, x4 binary"))
    start = after_word.where(F.col("left") == _signed(START)).first()
    tables.drop(known, after_word, after_pair, pairs)
    return table, start["fail"] if start else 0.0


# Columns x0, x1, .. of a packed table of weights: key, level, n, base, weight.
WEIGHTS = [np.int64, np.int8, np.int64, np.float64, np.float64]


class Front:
    """Weights of the most frequent n-grams, by key."""

    def __init__(self, keys: np.ndarray, base: np.ndarray, weight: np.ndarray) -> None:
        self.index, self.base, self.weight = HashIndex(keys), base, weight

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a key is here, its ``base`` and its weight (0 if not)."""
        at = self.index.find(keys)
        here = at >= 0
        if not len(self.base):
            return here, np.zeros(len(keys)), np.zeros(len(keys))
        return here, np.where(here, self.base[at], 0.0), np.where(here, self.weight[at], 0.0)


def _front(table: DataFrame, vocabulary: int, arcs: int) -> Front:
    """The most frequent n-grams of a packed table."""
    steps = 1024  # more than there are of a 64-bit number

    def step(n: np.ndarray) -> np.ndarray:
        return (np.log2(n) * 16).astype(np.int64)

    def histogram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(4 * steps, np.int64)
        for batch in batches:
            _, level, n = (_values(batch.column(f"x{k}"), 0, batch.num_rows, WEIGHTS[k]) for k in range(3))
            rows += np.bincount(level.astype(np.int64) * steps + step(n), minlength=4 * steps)
        at = np.flatnonzero(rows)
        yield pa.record_batch([pa.array(at // steps), pa.array(at % steps), pa.array(rows[at])], names=["level", "s", "rows"])

    counted = table.select("x0", "x1", "x2").mapInArrow(histogram, "level long, s long, rows long")
    counted = counted.groupBy("level", "s").agg(F.sum("rows").alias("rows")).collect()
    cuts = np.full(4, steps)
    for level, most in ((1, vocabulary), (2, arcs), (3, arcs)):
        cut = _cut([(r["s"], r["rows"]) for r in counted if r["level"] == level], most)
        cuts[level] = steps if cut is None else cut

    def most_frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, level, n, base, weight = (_values(batch.column(f"x{k}"), 0, batch.num_rows, d) for k, d in enumerate(WEIGHTS))
            kept = step(n) >= cuts[level]
            yield pa.record_batch([pa.array(c[kept]) for c in (key, base, weight)], names=["key", "base", "weight"])

    rows = table.drop("g").mapInArrow(most_frequent, "key long, base double, weight double").toArrow()
    key, base, weight = (rows.column(i).to_numpy() for i in range(3))
    return Front(key.view(U64), base, weight)


def _cut(histogram: list[tuple[int, int]], most: int) -> int | None:
    """The smallest step of the counts' logarithm from which on there are
    ``most`` rows at most, by a histogram (step, rows); None if there is none."""
    left, cut = most, None
    for step, rows in sorted(histogram, reverse=True):
        left -= rows
        if left < 0:
            break
        cut = step
    return cut


def _looked_up(rows: DataFrame, table: DataFrame, bits: int, part: int) -> DataFrame:
    """(row, low, more, found) of ``rows`` (row, rest), whose ``rest`` holds
    packed keys: sums of base and weight and number of words of those keys that
    the packed ``table`` has, for one of ``PARTS`` parts of the groups. In a task
    the keys asked for follow their group's part of the table."""

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def mine() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                n, rest = batch.num_rows, batch.column("rest")
                key = _values(rest, 0, n, np.int64)
                row = np.repeat(batch.column("row").to_numpy(), pc.binary_length(rest).to_numpy() // 8)
                here = _group_of(key, bits) % PARTS == part
                yield [key[here], row[here]]

        for key, row in _held(mine()):
            yield from _by_group(_group_of(key, bits), key, row)

    def summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        row, *values = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(row, kind="stable")
        row = row[order]
        head = runs(row)
        return [row[head], *(np.add.reduceat(v[order], head) if len(head) else v for v in values)]

    def out(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        row, *values = summed(parts)
        yield from _by_group(_group_of(mix(row), bits), row, *values)

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, known, front, parts, size = None, [], None, [], 0
        for (g, kind), (key, a, base) in _in_runs(batches, [np.int64, np.int64, np.float64], "g", "kind"):
            if g != group:
                group, known, front = g, [], None
            if kind == 0:
                known.append((key, base, a.view(np.float64)))
                continue
            if front is None:
                front = Front(*(np.concatenate(c) for c in zip(*known, strict=True))) if known else Front(key[:0], base[:0], base[:0])
                known = []
            here, low, more = front.find(key)
            low = low[here]
            parts.append(summed([[a[here], low, more[here], (low != 0).astype(np.int64)]]))
            size += len(parts[-1][0])
            if size > HELD:
                parts = [summed(parts)]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield from out(parts)
                    parts, size = [], 0
        if parts:
            yield from out(parts)

    def add_up(sums: pa.Table) -> pa.Table:
        columns = [_unpacked(sums, f"x{k}", d) for k, d in enumerate([np.int64, np.float64, np.float64, np.int64])]
        return pa.table(dict(zip(["row", "low", "more", "found"], summed([columns]), strict=True)))

    asks = rows.select("row", "rest").mapInArrow(asked, "g long, x0 binary, x1 binary")
    asks = asks.select("g", F.lit(1).alias("kind"), "x0", "x1", F.lit(b"").alias("x2"))
    mine = table.where(F.col("g") % PARTS == part)
    both = mine.select("g", F.lit(0).alias("kind"), "x0", F.col("x4").alias("x1"), F.col("x3").alias("x2")).union(asks)
    sums = both.repartition("g").sortWithinPartitions("g", "kind").mapInArrow(
        look_up, "g long, x0 binary, x1 binary, x2 binary, x3 binary"
    )
    return sums.groupBy("g").applyInArrow(add_up, "row long, low double, more double, found long")


def _most_frequent(counts: DataFrame, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of ``least`` or over the smallest cut-off that leaves
    ``most`` rows at most; the cut-off is found on a histogram of the counts."""
    if least > 1:  # read twice, and much smaller than all counts
        counts = counts.where(F.col("n") >= least).checkpoint()
    step = F.floor(F.log2("n") * 16)
    histogram = counts.where(F.col("n") >= least).groupBy(step.alias("s")).agg(F.count("*").alias("rows"))
    cut = _cut([(r["s"], r["rows"]) for r in histogram.collect()], most)
    if cut is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept = counts.where((F.col("n") >= least) & (step >= cut)).toArrow()
    keys, n = kept.column("key").to_numpy(), kept.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


class Automaton:
    """States, arcs and failure weights (natural order: tokens, pairs, triples)."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int, texts: int) -> None:
        if END not in words.view(U64):
            words, counts = np.append(words, np.array([END], U64).view(np.int64)), np.append(counts, 0)
        self.words, self.counts = HashIndex(words.view(U64)), counts
        self.start = len(words)  # the state before the first token
        self.base = np.log10((counts + 1.0) / (total + distinct + 1.0))
        self.histories = np.append(counts, texts).astype(np.float64)
        self.unseen = -np.log10(total + distinct + 1.0)
        empty = np.zeros(0, np.int64)
        self.add_pairs(empty, empty)
        self.add_triples(empty, empty)

    def __getstate__(self) -> dict:
        """What the executors need: not what only the fitting reads."""
        state = dict(self.__dict__)
        for name in ("histories", "pair_n", "_pair_right"):
            state.pop(name, None)
        return state

    def add_pairs(self, keys: np.ndarray, n: np.ndarray) -> None:
        left, right = keys >> BITS, keys & ((1 << BITS) - 1)
        p = (n - DISCOUNT) / self.histories[left] if len(keys) else np.zeros(0)
        self.pairs, self.pair_n = HashIndex(keys), n.astype(np.float64)
        size = len(self.histories)
        taken = np.bincount(left, weights=p, minlength=size)
        under = np.bincount(left, weights=10.0 ** self.base[right], minlength=size) if len(keys) else np.zeros(size)
        self.fail_word = np.log10(np.clip(1 - taken, 1e-12, 1) / np.clip(1 - under, 1e-12, 1))
        self.pair_log = np.log10(p)
        self._pair_right = right

    def add_triples(self, keys: np.ndarray, n: np.ndarray) -> None:
        pair, word = keys >> BITS, keys & ((1 << BITS) - 1)
        p = (n - DISCOUNT) / self.pair_n[pair] if len(keys) else np.zeros(0)
        self.triples, self.triple_log = HashIndex(keys), np.log10(p)
        middle = self._pair_right[pair] if len(keys) else pair
        lower = 10.0 ** self.after_word(middle, word)
        size = len(self.pair_n)
        taken = np.bincount(pair, weights=p, minlength=size)
        under = np.bincount(pair, weights=lower, minlength=size)
        self.fail_pair = np.log10(np.clip(1 - taken, 1e-12, 1) / np.clip(1 - under, 1e-12, 1))

    def after_word(self, left: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 P(word | one token of history)."""
        if not len(left):
            return np.zeros(0)
        at = self.pairs.find((left.astype(np.int64) << BITS) | word)
        return np.where(at >= 0, self.pair_log[at] if len(self.pair_log) else 0.0, self.fail_word[left] + self.base[word])

    def words_and_pairs(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per token: index (-1: outside the vocabulary), index of the token
        before, pair with it, and the pair before (the longest state)."""
        word = self.words.find(t.hash).astype(np.int64)
        left = np.empty_like(word)
        left[1:] = word[:-1]
        left[t.first] = self.start
        both = np.flatnonzero((word >= 0) & (left >= 0))
        pair = np.full(len(word), -1, np.int64)
        pair[both] = self.pairs.find((left[both] << BITS) | word[both])
        before = np.full(len(word), -1, np.int64)
        before[1:] = pair[:-1]
        before[t.first] = -1
        return word, left, pair, before

    def pair_keys(self, t: Tokens) -> np.ndarray:
        word, left, _, _ = self.words_and_pairs(t)
        both = (word >= 0) & (left >= 0)
        return (left[both] << BITS) | word[both]

    def triple_keys(self, t: Tokens) -> np.ndarray:
        word, _, _, before = self.words_and_pairs(t)
        both = (word >= 0) & (before >= 0)
        return (before[both] << BITS) | word[both]

    def read(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Per token: index, and log10 of its probability after what came
        before. Outside the vocabulary it lacks the unigram part."""
        word, left, pair, before = self.words_and_pairs(t)
        known = word >= 0
        low = np.where(known, self.base[word], 0.0)
        out = np.where(left >= 0, self.fail_word[left], 0.0) + low
        if len(self.pair_log):
            out = np.where(pair >= 0, self.pair_log[pair], out)
            deep = np.flatnonzero(before >= 0)
            fail = self.fail_pair[before[deep]] + out[deep]
            hit = np.full(len(deep), -1, np.int64)
            sure = known[deep]
            hit[sure] = self.triples.find((before[deep][sure] << BITS) | word[deep][sure])
            out[deep] = np.where(hit >= 0, self.triple_log[hit], fail) if len(self.triple_log) else fail
        return word, out


def count_words(texts: DataFrame, tables: Tables | None = None) -> tuple[DataFrame, int, int, int]:
    """Complete count table (key, n), its sums N and V, and the number of texts."""
    counts = _count(texts, lambda t: t.hash)
    counts = tables.keep(counts) if tables else counts.checkpoint()
    row = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("key") == _signed(END), F.col("n"))), F.lit(0))
    ).first()
    return counts, *map(int, row)


def train(texts: DataFrame, vocabulary: int = VOCABULARY, arcs: int = ARCS) -> tuple[Automaton, DataFrame, int, int]:
    """Automaton of at most ``vocabulary`` words and ``arcs`` pairs and triples
    (the most frequent) from the column ``text`` (no nulls); also the complete
    count table (key, n) and its sums N and V."""
    sc = texts.sparkSession.sparkContext
    counts, total, distinct, rows = count_words(texts)
    words, n = _most_frequent(counts, vocabulary, 1)
    model = Automaton(words, n, total, distinct, rows)
    for keys_of, add in ((Automaton.pair_keys, model.add_pairs), (Automaton.triple_keys, model.add_triples)):
        sent = sc.broadcast(model)
        add(*_most_frequent(_count(texts, lambda t: keys_of(sent.value, t)), arcs, 2))  # noqa: B023 - counted here
        sent.destroy()
    return model, counts, total, distinct


def score(
    df: DataFrame,
    id_col: str,
    text_col: str,
    train_where: Column,
    vocabulary: int = VOCABULARY,
    arcs: int = ARCS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities),
    learnt from the rows of ``train_where``."""
    spark = df.sparkSession
    prepare(spark)
    with freeing_shuffles(spark):
        return _score(df, id_col, text_col, train_where, vocabulary, arcs)


def _score(df: DataFrame, id_col: str, text_col: str, train_where: Column, vocabulary: int, arcs: int) -> DataFrame:
    spark = df.sparkSession
    tables = Tables(spark, "backoff")
    texts = df.where(train_where).select(whole_text(text_col).alias("text"))
    counts, total, distinct, n_texts = count_words(texts, tables)
    table, start = gram_weights(tables, texts, counts, total, distinct, n_texts)
    tables.drop(counts)
    front, marks = _front(table, vocabulary, arcs), _marks(table.select(F.col("x0").alias("key")))
    sent = spark.sparkContext.broadcast((front, marks))

    @F.arrow_udf("n_tokens long, n_known long, base double, score double, n_rare long, rest binary")
    def read(text: pa.Array) -> pa.Array:
        (front, marks), parts = sent.value, []
        for piece in pieces(pa.record_batch([text], names=["text"]), 0):
            t = tokens_of(piece.column(0))
            n = piece.num_rows
            pair = pairs_of(t)[0]
            there = marks.may_have(pair)
            both = _both(there, t)
            triple = _joined(pair[both - 1], pair[both], 3)
            # What isn't marked has no weight; a triple's parts have one, too.
            word_there, triple_there = marks.may_have(t.hash), marks.may_have(triple)
            key = np.concatenate([t.hash[word_there], pair[there], triple[triple_there]])
            of = np.concatenate([t.text[word_there], t.text[there], t.text[both[triple_there]]])
            here, base, weight = front.find(key)
            words = int(word_there.sum())
            known = of[:words][here[:words]]
            rest = np.flatnonzero(~here)
            rest = rest[np.argsort(of[rest], kind="stable")]
            ends = 8 * np.searchsorted(of[rest], np.arange(n + 1)).astype(np.int32)
            n_tokens, n_known = np.bincount(t.text, minlength=n), np.bincount(known, minlength=n)
            parts.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array(n_tokens),
                        pa.array(n_known),
                        pa.array(np.bincount(of, weights=base, minlength=n)),
                        pa.array(np.bincount(of, weights=weight, minlength=n) + start),
                        pa.array(n_tokens - n_known),
                        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(key[rest])]),
                    ],
                    names=["n_tokens", "n_known", "base", "score", "n_rare", "rest"],
                )
            )
        return pa.concat_arrays(parts)

    rows = tables.keep(  # row numbers hold from here on
        df.select(col(id_col).alias("id"), read(whole_text(text_col)).alias("r"))
        .select("id", "r.*")
        .withColumn("row", F.monotonically_increasing_id())
    )
    sent.destroy()
    found = []
    for part in range(PARTS):
        found.append(tables.keep(_looked_up(rows, table, _bits(total), part)))
    tables.drop(table)
    each = found[0]
    for more in found[1:]:
        each = each.unionByName(more)
    rest = each.groupBy("row").agg(F.sum("low").alias("low"), F.sum("more").alias("more"), F.sum("found").alias("found"))
    n_found = F.coalesce("found", F.lit(0))
    unseen = (F.col("n_rare") - n_found) * F.lit(-math.log10(total + distinct + 1.0))
    out = tables.keep(
        rows.join(rest, "row", "left").select(
            F.col("id").alias(id_col),
            "n_tokens",
            (F.col("n_known") + n_found).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("low", F.lit(0.0)) + unseen).alias("base_score"),
            (F.col("score") + F.coalesce("more", F.lit(0.0)) + unseen).alias("score"),
        )
    )
    tables.drop(rows, *found)
    return out
