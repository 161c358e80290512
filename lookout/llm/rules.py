"""Quality rules with a bitmask ledger (operator 3).

Every rule is evaluated once per text. The *ledger* keeps the measurements
and one bit per rule that the text fails. A *policy* names the rules that
count, under a version; applying one is a bitwise AND with its mask, so
policies are changed, compared and repeated without touching a text again.
*Ablations* need only the number of texts per distinct bitmask (at most
``2 ** len(RULES)`` rows, combined before the shuffle): for each rule of a
policy, how many texts fail it, how many fail nothing else, and how many
would be kept without it.

Defined cases: a null text is empty and fails ``few_words``; shares of an
empty text are 0; repeated rows are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text
from lookout.llm.words import IS_WORD, Powers, find_words, mix, pieces, range_hash, runs, string_buffer

_TRIPLE = Powers(0xE7037ED1A0B428DB)

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_shouts",
    "longest_word",
)


class Rule(NamedTuple):
    """A text fails where ``fails`` (SQL over the measurements) holds."""

    name: str
    fails: str


# Fixed order: the position is the rule's bit. New rules go to the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 2 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("upper_case", "n_upper > n_lower"),
    Rule("shouting", "10 * n_shouts > 2 * n_words"),
    Rule("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("endless_word", "longest_word > 1000"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


class Policy(NamedTuple):
    """The rules that reject, under a name and a version."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(r.name for r in RULES))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes within each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _chars(letters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(letters.encode())] = True
    return table


_SYMBOLS = _chars("#*$%&|<>")
_UPPER = _chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _chars("abcdefghijklmnopqrstuvwxyz")
_SHOUT = _chars("!")


def repeated_words(hashes: np.ndarray, first: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text, words inside windows of ``size`` words that it has twice or more."""
    counts = np.diff(first)
    n = len(hashes)
    out = np.zeros(len(counts), np.int64)
    if n < size:
        return out
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(n - size + 1)
    at = at[text[at] == text[at + size - 1]]
    # The text goes into the hash, so that one sort does for all texts.
    value = mix(range_hash(hashes, at, at + size, _TRIPLE)) ^ mix(text[at] + 1)
    order = np.argsort(value)
    head = runs(value[order], text[at[order]])
    length = np.diff(np.append(head, len(order)))
    again = at[order[np.repeat(length > 1, length)]]
    covered = np.zeros(n, dtype=bool)
    for i in range(size):
        covered[again + i] = True
    return np.bincount(text[covered], minlength=len(counts))


def measured(texts: pa.Array) -> pa.StructArray:
    """The measurements of each text (no nulls)."""
    buf, offsets = string_buffer(texts)
    w = find_words(texts)
    n = len(texts)
    size = w.end - w.start
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, w.text_of(), size)
    points = IS_WORD[buf] & ((buf & 0xC0) != 0x80)  # first bytes of characters in words
    lines, again = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = buf.tobytes()
    for i in range(n):
        seen = [line for line in raw[offsets[i] : offsets[i + 1]].split(b"\n") if line and line.strip()]
        lines[i] = len(seen)
        again[i] = len(seen) - len(set(seen))
    values = (
        w.counts(),
        _per_text(points, offsets),
        _per_text(_SYMBOLS[buf], offsets),
        again,
        repeated_words(w.hash, w.first),
        lines,
        _per_text(_UPPER[buf], offsets),
        _per_text(_LOWER[buf], offsets),
        _per_text(_SHOUT[buf], offsets),
        longest,
    )
    return pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in values], names=list(MEASURES))


def ledger(df: DataFrame, text_col: str) -> DataFrame:
    """All rows and columns of ``df`` with the measurements and ``failed``,
    the bitmask of failed rules (columns of these names are replaced)."""
    prepare(df.sparkSession)

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def measure(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([measured(p.column(0)) for p in pieces(pa.record_batch([texts], names=["t"]), 0)])

    m = OWN + "measures"
    out = df.withColumn(m, measure(whole_text(text_col)))
    new = [*MEASURES, "failed"]
    out = out.select(*[col(c) for c in df.columns if c not in new], f"{m}.*")
    bits = [F.when(F.expr(r.fails), F.lit(BIT[r.name])).otherwise(0).cast("long") for r in RULES]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return out.withColumn("failed", failed)


def rejected_by(policy: Policy, failed: Column | str = "failed") -> Column:
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def verdicts(ledger_df: DataFrame, policies: Iterable[Policy]) -> DataFrame:
    """The ledger with one column ``kept_<name>_v<version>`` per policy."""
    return ledger_df.withColumns({f"kept_{p.name}_v{p.version}": ~rejected_by(p) for p in policies})


def ablations(ledger_df: DataFrame, policies: Iterable[Policy]) -> DataFrame:
    """(policy, version, rule, n_texts, n_kept, n_failed, n_only,
    n_kept_without) for every rule of every policy."""
    masks = ledger_df.groupBy("failed").agg(F.count("*").alias("n"))
    parts = []
    for p in policies:
        mask = F.lit(p.mask).cast("long")
        for rule in dict.fromkeys(p.rules):
            bit = F.lit(BIT[rule]).cast("long")
            others = F.lit(p.mask & ~BIT[rule]).cast("long")
            parts.append(
                F.struct(
                    F.lit(p.name).alias("policy"),
                    F.lit(p.version).alias("version"),
                    F.lit(rule).alias("rule"),
                    (F.col("failed").bitwiseAND(mask) == 0).alias("kept"),
                    (F.col("failed").bitwiseAND(bit) != 0).alias("fails"),
                    (F.col("failed").bitwiseAND(mask) == bit).alias("only"),
                    (F.col("failed").bitwiseAND(others) == 0).alias("kept_without"),
                )
            )
    each = masks.select("n", F.explode(F.array(*parts)).alias("r")).select("n", "r.*")
    total = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return each.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_texts"),
        total("kept").alias("n_kept"),
        total("fails").alias("n_failed"),
        total("only").alias("n_only"),
        total("kept_without").alias("n_kept_without"),
    )
