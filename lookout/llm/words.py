"""Vectorised word handling on Arrow string buffers.

A word is a maximal run of bytes outside space and ``\\t\\n\\v\\f\\r`` (the
pattern ``[^\\x20\\x09-\\x0D]+``; multi-byte characters never contain those
bytes, so working on UTF-8 bytes is exact). Words are never turned into
Python strings: a word is a byte span plus a 64-bit polynomial hash.

Everything works on bounded pieces of a batch, so memory does not follow the
partition. One text is always kept whole.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False

# Bytes of text hashed at once (eight bytes of scratch per byte, four times).
HASH_CHUNK = 256 * 1024
# Bytes of text handled at once by the per-word code.
PIECE_BYTES = 4 * 1024 * 1024

U64 = np.uint64


def _give_back() -> None:
    """In a Python worker freed arrays of ``OWN_PAGES`` bytes and more go back
    to the system at once. Else the C library keeps them for the worker, which
    stays for the stages to come, and its size is that of its largest task."""
    if TaskContext.get() is None:  # not in the driver, whose process is the caller's
        return
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError):
        return  # another C library
    mallopt(-3, OWN_PAGES)  # M_MMAP_THRESHOLD
    mallopt(-1, 2 * OWN_PAGES)  # M_TRIM_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())


OWN_PAGES = 4 * 1024 * 1024
_give_back()

# Seconds after which tables that a worker keeps may go.
IDLE = 5
_KEPT: dict[str, tuple[float, object]] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """The tables of ``make()``, which a worker makes once and keeps for its
    next tasks (those of one key)."""
    tables = _KEPT[key][1] if key in _KEPT else None
    if tables is None:
        _KEPT.clear()
        tables = make()
    _KEPT[key] = (time.monotonic(), tables)
    return tables


def drop_idle() -> None:
    """For tasks that need no kept tables: workers outlive a stage, and the
    tables of one that has ended (unasked for in ``IDLE`` seconds) go back to
    the system instead of adding to what these tasks hold."""
    old = [k for k, (asked, _) in _KEPT.items() if time.monotonic() - asked > IDLE]
    for key in old:
        del _KEPT[key]
    if old and TaskContext.get() is not None:
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            return  # another C library


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTES = _byte_table(1)
BYTES_LOWER = BYTES.copy()
BYTES_LOWER[65:91] = BYTES[97:123]


class Powers:
    """``base**i`` and ``base**-i`` modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 5 * len(self.up) // 4)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, factor, dtype=U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


_BYTE_POWERS = Powers(0x5851F42D4C957F2D)


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of ``values[start:end]`` for many ranges: the same content gives
    the same hash wherever it lies (prefix sums of a polynomial)."""
    up, down = powers.upto(len(values))
    prefix = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return (prefix[end] - prefix[start]) * down[start]


class Words(NamedTuple):
    """Words of several texts: byte span and hash of each, and for each text
    the index of its first word (one more entry at the end)."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def string_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without nulls, and the offsets of its values."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span; starts and ends both ascend. ``lower``: A-Z
    and a-z hash alike."""
    hashes = np.empty(len(start), dtype=U64)
    table = BYTES_LOWER if lower else BYTES
    i = 0
    while i < len(start):  # a chunk ends with a span, so that none is cut
        base = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, base + HASH_CHUNK, side="right")))
        s, e = start[i:j] - base, end[i:j] - base
        hashes[i:j] = range_hash(table[buf[base : base + int(e[-1])]], s, e, _BYTE_POWERS)
        i = j
    return mix(hashes + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


def find_words(arr: pa.Array, lower: bool = False, hashed: bool = True, inside: np.ndarray = IS_WORD) -> Words:
    """Words of a string array without nulls; ``inside`` tells the bytes of a
    word. ``lower``: A-Z and a-z hash alike."""
    buf, offsets = string_buffer(arr)
    n = len(buf)
    word = inside[buf]
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False  # first byte of each text (or of the next that has any)
    start = np.flatnonzero(word & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    end = np.flatnonzero(word & ~after) + 1
    first = np.searchsorted(start, offsets)
    hashes = hash_spans(buf, start, end, lower) if hashed else np.zeros(0, U64)
    return Words(buf, start, end, hashes, first)


def pieces(batch: pa.RecordBatch, text: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of column ``text`` (one
    row at least)."""
    n = batch.num_rows
    if not n:
        return
    _, offsets = string_buffer(batch.column(text))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def runs(*same: np.ndarray) -> np.ndarray:
    """Start index of each run of equal neighbours (in all the given arrays)."""
    n = len(same[0])
    if not n:
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for a in same:
        new[1:] |= a[1:] != a[:-1]
    return np.flatnonzero(new)


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``first[i] .. first[i] + length[i] - 1``, in order."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    offset = np.repeat(first - (np.cumsum(length) - length), length)
    return offset + np.arange(total)
