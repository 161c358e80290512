"""BPE encoding and decoding (operator 1).

*Encoding* walks a word from left to right. An Aho-Corasick automaton over
all tokens gives, for every position, the tokens that start there; the
longest is tried first. It may follow the token before it only if the two are
*compatible*: merging the two tokens' symbols by rank would leave exactly
this pair. Where no token fits, the walk goes back one token and tries its
next shorter one; a position that failed once is never tried again, as the
encoding of a prefix is unique. So the walk is linear and its result is that
of the merges. Compatibility is computed from the merge table on first use
and kept in a table.

*Decoding* gathers byte ranges: all tokens lie in one byte string behind an
offset table, and a text is the ranges of its ids, one after another.

The tokenizer file names vocabulary, merges, the end-of-word mark, special
tokens, normalisation (NFC, white space, lower case) and the split pattern;
other kinds of steps are refused. Texts are cut at white space first. The
distinct pieces of half a megabyte of texts are normalised and split together,
every distinct word is encoded once, and the texts' ids are gathered from
theirs; ids of recent pieces and words are kept in bounded tables per worker.

Defined cases: null is the empty text, which has no ids and decodes to the
empty text; null ids decode like none; ids outside the vocabulary are left
out when decoding.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text
from lookout.llm.words import U64, kept, mix, spread, string_buffer

# Pieces and words whose ids a worker keeps, and pairs of tokens.
CACHE = 40_000
PAIRS = 100_000
PAIR_SLOTS = 1 << 19
# Bytes of texts whose pieces are encoded together (one text at least).
TOGETHER = 1 << 19
# Words that are walked at once, and the letters of those walked alone.
WALKED = 5_000
LONG = 64
# Tokens decoded at once (one text at least).
DECODED = 100_000
# Stands behind the last byte of a word in the automaton's alphabet.
MARK = "\uffff"
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = re.compile(f"[{BLANK}]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the letters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _classes(pattern: str) -> str:
    """The pattern with letters, numbers and white space spelled out as ranges
    (of the Unicode version that Python knows)."""
    found: dict[str, list[int]] = {"L": [], "N": []}
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in found:
            ranges = found[kind]
            if ranges and ranges[-1] == c - 1:
                ranges[-1] = c
            else:
                ranges += [c, c]
    for kind, ends in found.items():
        text = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(ends[::2], ends[1::2], strict=True))
        pattern = pattern.replace(rf"\p{{{kind}}}", text)
    return pattern.replace(r"\s", BLANK)


class Recent:
    """Values of recent keys, at most twice ``CACHE``: when the young half is
    full it becomes the old one, and what was not asked for since is forgotten."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}
        self.always: dict = {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def find(self, keys) -> tuple[dict, list]:
        """(values of known keys, unknown keys)."""
        young, old = self.young, self.old
        found, missing, again = dict(self.always), [], {}
        for key in keys:
            value = young.get(key)
            if value is None:
                value = old.get(key)
                if value is None:
                    if key not in found:
                        missing.append(key)
                    continue
                again[key] = value
            found[key] = value
        self.keep(again)
        return found, missing

    def keep(self, items: dict) -> None:
        for key, value in items.items():
            if len(key) <= 64:
                if len(self.young) >= CACHE:
                    self.old, self.young = self.young, {}
                self.young[key] = value


class Tokenizer:
    """Tables of one tokenizer file (its JSON text)."""

    def __init__(self, source: str) -> None:
        self.spec = spec = json.loads(source)
        model = spec["model"]
        other = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in other):
            raise ValueError("only plain BPE models are supported")
        self._steps(spec)
        names = [""] * (max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for name, i in model["vocab"].items():
            names[i] = name
        for t in spec["added_tokens"]:
            names[t["id"]] = t["content"]
        blob = [n.encode() + b" " for n in names]
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
        self.automaton = None  # what only encoding needs is made on first use

    def _prepare(self) -> None:
        import ahocorasick

        model, self.spec = self.spec["model"], None
        suffix = model.get("end_of_word_suffix") or ""
        self.end = MARK if suffix else ""
        vocab: dict[str, int] = model["vocab"]

        # Ranks order the tokens as the merges make them; single symbols first.
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in reversed(pairs)}
        self.rank = {i: 0 for i in vocab.values() if i not in made}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(pairs, 1):
            self.merge.setdefault((vocab[a], vocab[b]), vocab[a + b])
            self.rank.setdefault(vocab[a + b], rank)
        self.parts = made
        self.fits: dict[int, bool] = {}  # by left << 32 | right
        self.fits_before: dict[int, bool] = {}  # the half of the table that goes next

        shapes: dict[str, int] = {}
        for name, i in vocab.items():
            shape = name[: -len(suffix)] + MARK if suffix and name.endswith(suffix) else name
            shapes[shape] = i
        # A token that its own symbols don't merge to never occurs.
        shapes = {x: i for x, i in shapes.items() if i not in made or self._arises(i, *made[i])}
        self.length = {i: len(x) for x, i in shapes.items()}
        # The next shorter token with which a token begins (-1: none).
        self.shorter: dict[int, int] = {}
        automaton = ahocorasick.Automaton()
        for shape, i in shapes.items():
            automaton.add_word(shape, i)
            prefix = next((shape[:n] for n in range(len(shape) - 1, 0, -1) if shape[:n] in shapes), None)
            self.shorter[i] = -1 if prefix is None else shapes[prefix]
        automaton.make_automaton()
        # The same by token, and the table of pairs, for many words at a time.
        self.lengths, self.shorter_of = (np.zeros(len(self.offset), np.int64) - i for i in (0, 1))
        for i in shapes.values():
            self.lengths[i], self.shorter_of[i] = self.length[i], self.shorter[i]
        self.pair_keys, self.pair_fits = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, dtype=bool)

        letters = byte_letters()
        # A line end stands between words while they are spelled out.
        self.letters = {b: c for b, c in letters.items() if chr(b) != c and b != 10}
        self.split = re.compile("\n|" + _classes(self.pattern))
        self.cache = Recent()  # ids by piece of a text
        self.words = Recent()  # by word
        if self.special:
            self.cache.always = {ids: ids for ids in self.special.values()}
        self.automaton = automaton

    def _steps(self, spec: dict) -> None:
        """Reads the steps around the model; refuses those that aren't known."""
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"normalisation {kinds} is not supported")
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
        if not plain or level["add_prefix_space"] or level["use_regex"]:
            raise ValueError("this pre-tokenizer is not supported")
        if spec.get("decoder") is not None:
            raise ValueError("this decoder is not supported")
        self.pattern = split["pattern"]["Regex"]
        special = spec["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("only plain special tokens are supported")
        self.special = {t["content"]: np.array([t["id"]], np.int32).tobytes() for t in special}
        longest = sorted(self.special, key=len, reverse=True)
        self.find_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if special else None
        self.special_starts = {t[:2] for t in self.special}

    def _arises(self, token: int, a: int, b: int) -> bool:
        return self.merge.get((a, b)) == token and self._apart(a, b, self.rank[token])

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b side by side as they are."""
        key = a << 32 | b
        ok = self.fits_before.get(key)
        if ok is None:
            ok = self._apart(a, b, len(self.merge) + 1)
        if len(self.fits) >= PAIRS:
            self.fits_before, self.fits = self.fits, {}
        self.fits[key] = ok
        return ok

    def _apart(self, a: int, b: int, before: int) -> bool:
        """No merge of a rank under ``before`` joins the symbols where a and b
        meet. Both are taken apart from the latest merge back: at each moment
        the pair that meets there must not merge before one of its halves
        was made."""
        rank, merge, parts = self.rank, self.merge, self.parts
        until = before
        while True:
            joined = merge.get((a, b))
            if joined is not None and rank[joined] < until:
                return False
            # The half that was made last is taken apart. Of two equal ranks
            # the left one is made first, so the right one is undone first.
            if rank[a] > rank[b]:
                until = rank[a]
                a = parts[a][1]
            elif rank[b] > 0:
                until = rank[b] + 1
                b = parts[b][0]
            else:
                return True

    def word(self, text: str) -> list[int]:
        """Ids of one word given in the byte-level alphabet."""
        s = text + self.end
        n, length, shorter = len(s), self.length, self.shorter
        longest = [-1] * (n + 1)  # the longest token that starts at a position
        for last, token in self.automaton.iter(s):
            longest[last + 1 - length[token]] = token  # ends ascend
        alive = [True] * (n + 1)
        out: list[int] = []
        at, left, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if alive[end]:
                    if left < 0:
                        break
                    ok = self.fits.get(left << 32 | token)
                    if self.compatible(left, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, left, token = end, token, longest[end]
            elif out:
                alive[at] = False
                last = out.pop()
                at -= length[last]
                left, token = out[-1] if out else -1, shorter[last]
            else:
                raise ValueError("a byte of the text is not in the vocabulary")
        return out

    def _parts(self, text: str) -> list:
        """The pieces of a text between white space; special tokens as the
        bytes of their ids."""
        if self.find_special is None or not any(s in text for s in self.special_starts):
            # str.split() also cuts at the four separators 1C-1F, which aren't white space here.
            return SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        out: list = []
        for i, part in enumerate(self.find_special.split(text)):
            if i % 2:
                out.append(self.special[part])
            else:
                out += SPACE.split(part)
        return out

    def _fit_together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`compatible` for many pairs. The table holds the last pair
        that fell on each of its slots."""
        keys = left << 32 | right
        slot = (mix(keys.view(U64)) & U64(PAIR_SLOTS - 1)).astype(np.int64)
        ok = self.pair_fits[slot]
        new = np.flatnonzero(self.pair_keys[slot] != keys)
        if len(new):
            some, back = np.unique(keys[new], return_inverse=True)
            last = len(self.merge) + 1
            fits = np.array([self._apart(k >> 32, k & 0xFFFFFFFF, last) for k in some.tolist()])[back]
            ok[new] = fits
            self.pair_keys[slot[new]], self.pair_fits[slot[new]] = keys[new], fits
        return ok

    def walk(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`word` for many words, all a step at a time: ids one after
        another, and how many each word has."""
        text = (self.end + "\n").join(words) + self.end
        size = np.array([len(w) for w in words]) + len(self.end)
        start = np.cumsum(size + 1) - (size + 1)
        goal = start + size
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        longest = np.full(len(text) + 2, -1, np.int64)  # the longest token that starts at a position
        longest[found[:, 0] + 1 - self.lengths[found[:, 1]]] = found[:, 1]  # ends ascend: the last one stays
        alive = np.ones(len(text) + 2, dtype=bool)
        before = np.full(len(text) + 2, -1, np.int64)  # the token that ends at a position of the walk
        todo = np.arange(len(words))
        at, left, token = start.copy(), np.full(len(words), -1, np.int64), longest[start]
        while len(todo):
            here, last, next_ = at[todo], left[todo], token[todo]
            some = next_ >= 0
            end = here + np.where(some, self.lengths[next_], 0)
            ok = some & alive[end]
            pair = np.flatnonzero(ok & (last >= 0))
            ok[pair] = self._fit_together(last[pair], next_[pair])
            on, other, back = todo[ok], todo[some & ~ok], todo[~some]
            before[end[ok]] = next_[ok]
            at[on], left[on], token[on] = end[ok], next_[ok], longest[end[ok]]
            token[other] = self.shorter_of[token[other]]
            if len(back):
                undone = left[back]
                if (undone < 0).any():
                    raise ValueError("a byte of the text is not in the vocabulary")
                alive[at[back]] = False
                at[back] -= self.lengths[undone]
                left[back] = np.where(at[back] > start[back], before[at[back]], -1)
                token[back] = self.shorter_of[undone]
            todo = todo[at[todo] < goal[todo]]
        # Back from each word's end, again all words at a time.
        ids, whose, at = [], [], goal.copy()
        todo = np.arange(len(words))
        while len(todo):
            got = before[at[todo]]
            ids.append(got)
            whose.append(todo)
            at[todo] -= self.lengths[got]
            todo = todo[at[todo] > start[todo]]
        whose, ids = np.concatenate(whose)[::-1], np.concatenate(ids)[::-1]
        return ids[np.argsort(whose, kind="stable")].astype(np.int32), np.bincount(whose, minlength=len(words))

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids (int32) of distinct words, lower-cased and split already."""
        found, missing = self.words.find(words)
        if missing:
            shown = "\n".join(missing)
            if not (shown.isascii() and shown.replace("\n", "").isprintable()):
                shown = shown.encode().decode("latin-1").translate(self.letters)
            spelt = shown.split("\n")
            fresh = {w: array("i", self.word(s)).tobytes() for w, s in zip(missing, spelt, strict=True) if len(s) > LONG}
            short = [i for i, s in enumerate(spelt) if len(s) <= LONG]
            for i in range(0, len(short), WALKED):
                some = short[i : i + WALKED]
                ids, n = self.walk([spelt[j] for j in some])
                raw, ends = ids.tobytes(), np.cumsum(4 * n).tolist()
                fresh |= {missing[j]: raw[a:b] for j, a, b in zip(some, [0, *ends], ends)}  # noqa: B905
            self.words.keep(fresh)
            found |= fresh
        return [found[w] for w in words]

    def _piece_ids(self, pieces: set) -> dict:
        """Ids (int32) of distinct pieces of texts. All that aren't known are
        normalised and split together, and every word in them is encoded once."""
        found, missing = self.cache.find(pieces)
        if missing:
            text = "\n".join(missing)
            if not text.isascii():  # sigma has no final form here
                text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
            cut = self.split.findall(text.lower())  # a line end is a part of its own
            words = [w for w in dict.fromkeys(cut) if w != "\n"]
            ids = dict(zip(words, self._word_ids(words), strict=True))
            fresh, at = {}, 0
            for piece in missing:
                end = cut.index("\n", at) if len(fresh) + 1 < len(missing) else len(cut)
                fresh[piece] = ids[cut[at]] if end == at + 1 else b"".join([ids[w] for w in cut[at:end]])
                at = end + 1
            self.cache.keep(fresh)
            found |= fresh
        return found

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids (int32) of each text. Distinct pieces are encoded once; the
        texts' ids are gathered from theirs."""
        if self.automaton is None:
            self._prepare()
        parts = [self._parts(t) for t in texts]
        ids = self._piece_ids(set().union(*parts))
        return [b"".join(map(ids.__getitem__, p)) for p in parts]

    def encode(self, text: str) -> bytes:
        """Ids (int32) of a text."""
        return self.encode_many([text])[0]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of the ids ``ids[ends[i]:ends[i + 1]]``, some at a time."""
        parts, i = [pa.nulls(0, pa.string())], 0
        while i < len(ends) - 1:
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + DECODED, side="right")) - 1)
            parts.append(self._texts(ids[ends[i] : ends[j]], ends[i : j + 1] - ends[i]))
            i = j
        return pa.concat_arrays(parts)

    def _texts(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        good = (ids >= 0) & (ids < len(self.offset) - 1)
        size = np.zeros(len(ids), np.int64)
        size[good] = self.offset[ids[good] + 1] - self.offset[ids[good]]
        bytes_to = np.concatenate([[0], np.cumsum(size)])
        raw = self.blob[spread(self.offset[np.where(good, ids, 0)], size)].tobytes()
        edges = bytes_to[ends]
        texts = [raw[x : max(x, y - 1)] for x, y in zip(edges[:-1], edges[1:], strict=True)]
        return pa.array(texts, pa.binary()).cast(pa.string())


def _tokenizer(source: str) -> Tokenizer:
    """The tables of a file, made once per worker (one file is kept)."""
    return kept(hashlib.sha256(source.encode()).hexdigest(), lambda: Tokenizer(source))


def _source(df: DataFrame, path: str):
    """The file (of a fixed size) for all executors; the driver reads it."""
    prepare(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _ids(tokenizer: Tokenizer, texts: pa.Array) -> pa.ListArray:
    """Ids of all texts, some at a time (one text at least)."""
    _, offsets = string_buffer(texts)
    flat, ends, i = bytearray(), [0], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TOGETHER, side="right")) - 1)
        for ids in tokenizer.encode_many(texts.slice(i, j - i).to_pylist()):
            flat += ids
            ends.append(len(flat) // 4)
        i = j
    values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(flat)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _texts(tokenizer: Tokenizer, ids: pa.ListArray) -> pa.Array:
    ends = ids.offsets.to_numpy()
    flat = ids.values.fill_null(-1).to_numpy()[ends[0] : ends[-1]] if len(ids) else np.zeros(0, np.int32)
    return tokenizer.decode(flat, ends - ends[0])


def encode(df: DataFrame, text_col: str, path: str, out: str = "ids") -> DataFrame:
    """All rows and columns with ``out``: the token ids of the whole text."""
    sent = _source(df, path)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _tokenizer(sent.value)
        for texts in batches:
            yield _ids(tokenizer, texts)
        pa.default_memory_pool().release_unused()

    return df.withColumn(OWN + "ids", ids(whole_text(text_col))).select(
        *[col(c) for c in df.columns if c != out], F.col(OWN + "ids").alias(out)
    )


def encode_decode(df: DataFrame, text_col: str, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """:func:`encode` and then :func:`decode` in one pass over the rows (the
    ids go from one to the other inside the worker)."""
    sent = _source(df, path)

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _tokenizer(sent.value)
        for texts in batches:
            found = _ids(tokenizer, texts)
            yield pa.StructArray.from_arrays([found, _texts(tokenizer, found)], names=["ids", "decoded"])
        pa.default_memory_pool().release_unused()

    b = OWN + "both"
    return df.withColumn(b, both(whole_text(text_col))).select(
        *[col(c) for c in df.columns if c not in (ids, decoded)],
        F.col(b)["ids"].alias(ids),
        F.col(b)["decoded"].alias(decoded),
    )


def decode(df: DataFrame, ids_col: str, path: str, out: str = "decoded") -> DataFrame:
    """All rows and columns with ``out``: the text of the ids."""
    sent = _source(df, path)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _tokenizer(sent.value)
        for ids in batches:
            yield _texts(tokenizer, ids)

    filled = F.coalesce(col(ids_col), F.array().cast("array<int>"))
    return df.withColumn(OWN + "text", text(filled)).select(
        *[col(c) for c in df.columns if c != out], F.col(OWN + "text").alias(out)
    )
