"""Spelling variant grouping (operator 11).

Words are runs of letters (A-Z, a-z and U+00C0 to U+00FF), so a word is one
byte per letter in Latin-1. Two words are *near* if one inserted, deleted or
replaced letter makes them equal.

*Letter counts.* A word's vector is how often each letter occurs. One edit
moves it by at most two in L1: a replaced letter takes one from a count and
adds one to another, an inserted one adds one. Counts are held as bits ("at
least one e", "at least two e", ...) in two 64-bit numbers, so the distance
of two vectors is a population count, never more than the true one; it is
split into what has to be added and what to be taken away.

*K-d trees.* A tree over the words of one length halves them again and again
at the count of one letter; each node has the box of its words (bits that all
have, bits that any has). A search takes many words at once down the tree and
leaves those behind whose own counts are further from the box than an edit
goes. Words of length L are searched in the trees of length L (one added, one
taken away) and L + 1 (one added). What is left is verified letter by letter.

*Distribution.* The upper levels of each length's tree are split points fitted
on a bounded sample of the vocabulary (``SAMPLE`` words by hash); every word is
then indexed in the block of its leaf, and a query visits the blocks that the
same pruning leaves. A task holds one block's words and their tree, and
streams the block's queries past it. Pairs of one length are found from one
side only: inside a block by order, between blocks by block number.

Defined cases: null texts have no words; a null id counts as empty text where
the id is hashed; rows are counted as often as they occur; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import col, joinable, prepare, whole_text
from lookout.llm.words import hash_spans, pieces, spread, string_buffer

# Words of the vocabulary that the split points are fitted on (a share by hash
# that gives so many).
SAMPLE = 1 << 17
# Words that a block should hold, and the fewest words of the sample in one.
BLOCK = 1 << 14
LEAST = 8
# Words in a leaf of a block's own tree; queries that go down it at once.
LEAF = 32
QUERIES = 1 << 14
# Rows of the table of roots up to which it is broadcast.
BROADCAST_ROOTS = 100_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_ASCII_LETTER = np.zeros(256, dtype=bool)
IS_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
# First byte of U+00C0 to U+00FF in UTF-8, a whole letter with the byte behind it.
TWO = 0xC3

CRC = np.zeros(256, dtype=np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    CRC[_i] = _c
# Spans over so many bytes are hashed one by one.
LONG = 64


def find_runs(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters of a string array without nulls: lower-cased bytes,
    start and end of each run, the index of its text, and its letters."""
    raw, offsets = string_buffer(arr)
    n = len(raw)
    two = raw == TWO
    inside = IS_ASCII_LETTER[raw] | two
    inside[1:] |= two[:-1]
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    twos = np.concatenate([[0], np.cumsum(two)])
    return LOWER[raw], start, end, text, end - start - (twos[end] - twos[start])


def crc_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each byte span, continued from the crc32 ``seed``."""
    size = end - start
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    at, left = start[order], size[order]
    state = seed[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    n_long = int((left > LONG).sum())
    for i in range(n_long):
        span = buf[at[i] : at[i] + left[i]].tobytes()
        state[i] = zlib.crc32(span, int(seed[order[i]])) ^ 0xFFFFFFFF
    todo = np.searchsorted(-left[n_long:], -np.arange(LONG), side="left")  # spans with more than k bytes
    for k, m in enumerate(todo.tolist()):
        if not m:
            break
        s = state[n_long : n_long + m]
        low = (s ^ buf[at[n_long : n_long + m] + k]) & np.uint32(255)
        state[n_long : n_long + m] = CRC[low] ^ (s >> np.uint32(8))
    out = np.empty(len(start), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _count_words(shortest: int, every: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                yield _piece_counts(piece, shortest, every)
        pa.default_memory_pool().release_unused()

    return run


def _piece_counts(piece: pa.RecordBatch, shortest: int, every: int) -> pa.RecordBatch:
    buf, start, end, text, letters = find_runs(piece.column(1))
    long = letters >= shortest
    start, end, text, letters = start[long], end[long], text[long], letters[long]
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in piece.column(0).to_pylist()], np.uint32)
    h = crc_spans(buf, start, end, prefix[text])
    cut = h % np.uint32(every) == 0

    # Words that lose a letter are few: one by one.
    lost: Counter[str] = Counter()
    todo = np.flatnonzero(cut & (letters > shortest))
    spans = zip(start[todo].tolist(), end[todo].tolist(), h[todo].tolist(), strict=True)
    for a, b, x in spans:
        word = buf[a:b].tobytes().decode()
        at = x % len(word)
        lost[word[:at] + word[at + 1 :]] += 1

    start, end = start[~cut], end[~cut]
    _, first, n = np.unique(hash_spans(buf, start, end), return_index=True, return_counts=True)
    size = end[first] - start[first]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = buf[spread(start[first], size)]
    words = pa.Array.from_buffers(
        pa.large_string(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    ).cast(pa.string())
    words = pa.concat_arrays([words, pa.array(list(lost), pa.string())])
    counts = np.concatenate([n.astype(np.int64), np.fromiter(lost.values(), np.int64, len(lost))])
    return pa.RecordBatch.from_arrays([words, pa.array(counts)], names=["word", "n"])


def vocabulary(
    df: DataFrame, id_col: str, text_col: str, shortest: int = 5, fewest: int = 3, every: int = 97
) -> DataFrame:
    """(word, n): lower-cased (A-Z only) runs of letters with at least
    ``shortest`` letters and ``fewest`` occurrences in all texts. Where
    ``every`` divides h, the crc32 of ``<id>:<run>``, the letter at h modulo
    the length is left out first."""
    prepare(df.sparkSession)
    rows = df.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("i"), whole_text(text_col).alias("t"))
    found = rows.mapInArrow(_count_words(shortest, every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# ---- letter counts as bits ---------------------------------------------------

# Bits of the first number: two counts of each letter a-z and a third of the
# twelve most usual; the second has one for each of U+00C0 to U+00FF.
THIRD = b"eaionrstludh"


def matrix(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def count_bits(letters: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each row of letters."""
    m, width = letters.shape
    out = np.zeros((m, 2), np.uint64)
    chunk = max(1, (1 << 22) // max(256, width))
    one = np.uint64(1)
    for i in range(0, m, chunk):
        part = letters[i : i + chunk]
        rows = np.arange(len(part))[:, None] * 256
        n = np.bincount((rows + part).reshape(-1), minlength=256 * len(part)).reshape(-1, 256)
        a, b = out[i : i + chunk, 0], out[i : i + chunk, 1]
        for k in range(26):
            a |= (n[:, 97 + k] >= 1).astype(np.uint64) << np.uint64(k)
            a |= (n[:, 97 + k] >= 2).astype(np.uint64) << np.uint64(26 + k)
        for k, letter in enumerate(THIRD):
            a |= (n[:, letter] >= 3).astype(np.uint64) << np.uint64(52 + k)
        for k in range(64):
            b |= (n[:, 192 + k] >= one) * (one << np.uint64(k))
    return out


def missing(need: np.ndarray, have: np.ndarray) -> np.ndarray:
    """How many bits of ``need`` are not in ``have``."""
    return np.bitwise_count(need & ~have).sum(axis=-1, dtype=np.int64)


def best_split(bits: np.ndarray) -> int:
    """The bit that halves the rows best (-1: all rows are alike)."""
    share = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1, bitorder="little").mean(axis=0)
    away = np.abs(share - 0.5)
    best = int(np.argmin(away))
    return best if away[best] < 0.5 else -1


def has_bit(bits: np.ndarray, bit: int) -> np.ndarray:
    return (bits[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) != 0


# ---- split points of a length, and the blocks behind them ---------------------


def fit_splits(bits: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """Nodes (bit, node without it, node with it) over a sample; a leaf has
    bit -1 and its block's number. Leaves hold ``most`` rows or fewer where
    rows differ."""
    nodes: list[tuple[int, int, int]] = []
    blocks = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal blocks
        here = len(nodes)
        nodes.append((-1, 0, 0))
        bit = best_split(rows) if len(rows) > most else -1
        if bit < 0:
            nodes[here] = (-1, blocks, 0)
            blocks += 1
        else:
            one = has_bit(rows, bit)
            nodes[here] = (bit, grow(rows[~one]), grow(rows[one]))
        return here

    grow(bits)
    return nodes


def route(
    nodes: list[tuple[int, int, int]], bits: np.ndarray, added: int, taken: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) for every block that a word with up to ``added`` letters
    more and ``taken`` fewer can lie in."""
    rows, blocks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [(0, np.arange(len(bits)), np.full(len(bits), added), np.full(len(bits), taken))]
    while todo:
        node, at, up, down = todo.pop()
        bit, zero, one = nodes[node]
        if bit < 0:
            rows.append(at)
            blocks.append(np.full(len(at), zero))
            continue
        has = has_bit(bits[at], bit)
        for child, u, d in ((zero, up, down - has), (one, up - ~has, down)):
            on = (u >= 0) & (d >= 0)
            if on.any():
                todo.append((child, at[on], u[on], d[on]))
    return np.concatenate(rows), np.concatenate(blocks)


def _fit(words: DataFrame) -> dict[int, list[tuple[int, int, int]]]:
    """Split points by length, from the sample."""
    total = words.count()
    share = min(1.0, SAMPLE / max(1, total))  # SAMPLE words within a few hundred
    picked = words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))).collect()
    by_length: dict[int, list[bytes]] = {}
    for r in picked:
        by_length.setdefault(len(r.word), []).append(r.word.encode("latin-1"))
    most = max(LEAST, BLOCK * len(picked) // max(1, total))
    return {n: fit_splits(count_bits(matrix(rows)), most) for n, rows in by_length.items()}


POINT, LEVEL, SHORTER = 0, 1, 2
ONE_BLOCK = [(-1, 0, 0)]
LENGTH_SHIFT = 20


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    length = np.array([len(w) for w in words], np.int64)
    for n in np.unique(length).tolist():
        yield n, np.flatnonzero(length == n)


def _deal(splits: dict[int, list[tuple[int, int, int]]]):
    """Rows (block, role, word, n): each word as a point of its own block and
    as a query of the others that it can have near words in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for n, index in _by_length(words):
                bits = count_bits(matrix([words[i] for i in index]))
                level, longer = splits.get(n, ONE_BLOCK), splits.get(n + 1, ONE_BLOCK)
                at, own = route(level, bits, 0, 0)
                home = np.empty(len(index), np.int64)
                home[at] = own
                row, block = route(level, bits, 1, 1)
                ahead = block > home[row]
                up, above = route(longer, bits, 1, 0)
                rows = np.concatenate([at, row[ahead], up])
                blocks = np.concatenate(
                    [
                        (n << LENGTH_SHIFT) + own,
                        (n << LENGTH_SHIFT) + block[ahead],
                        ((n + 1) << LENGTH_SHIFT) + above,
                    ]
                )
                role = np.repeat([POINT, LEVEL, SHORTER], [len(at), int(ahead.sum()), len(up)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks),
                        pa.array(role.astype(np.int32)),
                        *(batch.column(c).take(pa.array(index[rows])) for c in (0, 1)),
                    ],
                    names=["block", "role", "word", "n"],
                )

    return run


# ---- the tree of a block -------------------------------------------------------


class Tree:
    """K-d tree over words of one length (rows of letters)."""

    def __init__(self, letters: np.ndarray) -> None:
        self.letters = letters
        self.bits = count_bits(letters)
        # (lowest corner, highest corner, rows of a leaf or None, children)
        self.root = self._grow(np.arange(len(letters)))

    def _grow(self, rows: np.ndarray) -> tuple:
        bits = self.bits[rows]
        low, high = np.bitwise_and.reduce(bits, axis=0), np.bitwise_or.reduce(bits, axis=0)
        bit = best_split(bits) if len(rows) > LEAF else -1
        if bit < 0:
            return low, high, rows, ()
        one = has_bit(bits, bit)
        return low, high, None, (self._grow(rows[~one]), self._grow(rows[one]))

    def near(self, queries: np.ndarray, shorter: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all near words; ``queries`` are rows of letters of
        the same length, or one letter shorter."""
        bits, down = count_bits(queries), 0 if shorter else 1
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            (low, high, rows, children), at = todo.pop()
            q = bits[at]
            at = at[(missing(low, q) <= 1) & (missing(q, high) <= down)]
            if not len(at):
                continue
            if rows is None:
                todo += [(child, at) for child in children]
                continue
            step = max(1, (1 << 20) // len(rows))  # a leaf of equal counts can be large
            for i in range(0, len(at), step):
                q, p = bits[at[i : i + step], None, :], self.bits[None, rows, :]
                a, b = np.nonzero((missing(p, q) <= 1) & (missing(q, p) <= down))
                a, b = at[i : i + step][a], rows[b]
                ok = self._one_edit(queries, a, b, shorter)
                found.append((a[ok], b[ok]))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _one_edit(self, queries: np.ndarray, a: np.ndarray, b: np.ndarray, shorter: bool) -> np.ndarray:
        """Whether the letters in order differ by exactly one edit."""
        ok = np.zeros(len(a), dtype=bool)
        width = self.letters.shape[1]
        step = max(1, (1 << 22) // width)
        for i in range(0, len(a), step):
            q, p = queries[a[i : i + step]], self.letters[b[i : i + step]]
            if not shorter:
                ok[i : i + step] = (p != q).sum(axis=1) == 1
            else:  # a letter of p is left out behind the common beginning
                head = np.logical_and.accumulate(p[:, :-1] == q, axis=1).sum(axis=1)
                tail = np.logical_and.accumulate((p[:, 1:] == q)[:, ::-1], axis=1).sum(axis=1)
                ok[i : i + step] = head + tail >= width - 1
        return ok


class _Block:
    """Words of a block as they come in, and then the queries that visit it."""

    def __init__(self) -> None:
        self.words: list[bytes] = []
        self.n: list[int] = []
        self.tree: Tree | None = None
        self.waiting: dict[int, tuple[list[bytes], list[int]]] = {LEVEL: ([], []), SHORTER: ([], [])}

    def take(self, role: int, words: list[bytes], n: list[int]) -> Iterator[pa.RecordBatch]:
        if role == POINT:
            self.words += words
            self.n += n
            return
        held = self.waiting[role]
        held[0].extend(words)
        held[1].extend(n)
        if len(held[0]) >= QUERIES:
            yield from self.search(role)

    def search(self, role: int) -> Iterator[pa.RecordBatch]:
        words, n = self.waiting[role] if role != POINT else (self.words, self.n)
        if role != POINT:
            self.waiting[role] = ([], [])
        if not words or not self.words:
            return
        if self.tree is None:
            self.tree = Tree(matrix(self.words))
        for i in range(0, len(words), QUERIES):
            a, b = self.tree.near(matrix(words[i : i + QUERIES]), role == SHORTER)
            pairs = [(x + i, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            if role == POINT:
                pairs = [(x, y) for x, y in pairs if words[x] < words[y]]
            for j in range(0, len(pairs), 100_000):
                part = pairs[j : j + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([words[x].decode("latin-1") for x, _ in part], pa.string()),
                        pa.array([n[x] for x, _ in part], pa.int64()),
                        pa.array([self.words[y].decode("latin-1") for _, y in part], pa.string()),
                        pa.array([self.n[y] for _, y in part], pa.int64()),
                    ],
                    names=["a", "n_a", "b", "n_b"],
                )

    def close(self) -> Iterator[pa.RecordBatch]:
        for role in (POINT, LEVEL, SHORTER):
            yield from self.search(role)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and role: points, then queries."""
    block, held = None, _Block()
    for batch in batches:
        key, role = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (role[1:] != role[:-1])) + 1).tolist(), len(key)]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            if i == j:
                continue
            if key[i] != block:
                yield from held.close()
                block, held = key[i], _Block()
            words = [w.encode("latin-1") for w in batch.column(2).slice(i, j - i).to_pylist()]
            yield from held.take(int(role[i]), words, batch.column(3).slice(i, j - i).to_pylist())
    yield from held.close()


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) for every two near words of a vocabulary (word, n) of
    distinct words, once."""
    prepare(words.sparkSession)
    words = words.select("word", "n")
    dealt = words.mapInArrow(_deal(_fit(words)), "block long, role int, word string, n long")
    return (
        dealt.repartition("block")
        .sortWithinPartitions("block", "role")
        .mapInArrow(_search, "a string, n_a long, b string, n_b long")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last one, twice
    as far in each round. A form is at least twice as frequent as its word, so
    there are no circles and few rounds."""
    table = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        on = joinable(table.select(F.col("word").alias("root"), F.col("root").alias("next")), BROADCAST_ROOTS)
        step = table.join(on, "root", "left").select("word", "root", "next").checkpoint()
        further = step.where(F.col("next").isNotNull()).limit(1).count()
        table = step.select("word", F.coalesce("next", "root").alias("root"))
        if not further:
            return table


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary (word, n) of
    distinct words. ``form`` is the near word of largest n (ties: first in
    code-point order) if it has at least twice the word's n, ``root`` the last
    word that forms lead to (the word itself if none)."""
    words = words.select("word", "n").checkpoint()
    pairs = near_pairs(words).checkpoint()
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("o"), F.col("n_b").alias("o_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("o"), F.col("n_a").alias("o_n"))
    )
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("o_n")).alias("m"), F.col("o").alias("o"))).alias("best")
    )
    enough = -F.col("best.m") >= 2 * F.col("n")
    found = (
        words.join(near, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.o")).alias("form"),
            F.when(enough, -F.col("best.m")).alias("form_n"),
        )
        .checkpoint()
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
