"""Severity of toxic language by ordinal regression (operator 6).

A cumulative-link model: one linear score ``s = w . x`` over sparse text
features is shared by all ordered thresholds,

    P(grade > j) = sigmoid(s - theta_j),   theta_0 < theta_1 < ...

so the expected severity is the sum of these over j. Features are words
(letters only, A-Z lowered) and their first four to six bytes, which tie
invented variants of a word together; ``x`` is log(1 + occurrences).

Spark counts in how many sample documents of either label each feature
occurs, over all features. All that are tied to the toxic label beyond chance
(a log-likelihood ratio past the level at which one of all features would pass
by luck) form the model; weights and thresholds are then fitted together.
The sample is bounded (``PER_CLASS`` documents of each label); every document
is scored over its whole text.

``labels`` only says toxic or not. Its documents are graded for training by
how often they use the found words, each use counted by the share that clean
documents don't explain (1 - 1 / lift, the lift being how many times as common
the feature is in toxic documents): ``LEVELS`` uses or more reach the next
grade, and a toxic document has grade 1 at least.

Defined cases: a null or empty text has no features and the score of the
lowest grade; without labelled rows of both kinds all severities are 0;
repeated rows are scored each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text
from lookout.llm.lookup import HashIndex
from lookout.llm.samples import labelled_sample
from lookout.llm.words import U64, find_words, hash_spans, mix, pieces, runs

PER_CLASS = 6000
LEVELS = (3, 6)
PREFIXES = (4, 5, 6)
STEPS = 500

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of feature: (hash, text index, word index) of every word that has it."""
    w = find_words(texts, lower=True, inside=_LETTER)
    text, size = w.text_of(), w.end - w.start
    index = np.arange(len(size))
    out = [(w.hash, text, index)]
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        head = hash_spans(w.buf, w.start[long], w.start[long] + n, lower=True)
        out.append((mix(head + U64(n)), text[long], long))
    return out


def _feature_counts(batches):
    """(text, label) -> (feature, documents of label 0, of label 1)."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged():
        key = np.concatenate([h[0] for h in held])
        key, at = np.unique(key, return_inverse=True)
        n0 = np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
        n1 = np.bincount(at, weights=np.concatenate([h[2] for h in held])).astype(np.int64)
        return key, n0, n1

    def out(key, n0, n1):
        return pa.record_batch([pa.array(key.view(np.int64)), pa.array(n0), pa.array(n1)], names=["key", "n0", "n1"])

    for batch in batches:
        for piece in pieces(batch, 0):
            label = piece.column(1).to_numpy()
            for key, text, _ in word_features(piece.column(0)):
                order = np.lexsort((text, key))
                head = order[runs(key[order], text[order])]
                key, at = np.unique(key[head], return_inverse=True)
                one = label[text[head]]
                held.append((key, np.bincount(at, weights=1 - one), np.bincount(at, weights=one)))
            if sum(len(h[0]) for h in held) > 2_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield out(*held.pop())
    if held:
        yield out(*merged())


class Ordinal:
    """Feature hashes, weights and thresholds."""

    def __init__(self, features: np.ndarray, grades: int, share: np.ndarray | None = None) -> None:
        """``share``: of a feature's uses, the part that only toxicity explains."""
        self.index = HashIndex(features)
        self.share = np.ones(len(features)) if share is None else share
        self.weight = np.zeros(len(features))
        self.theta = np.arange(grades - 1, dtype=np.float64) + 20.0  # nothing is toxic before fitting

    def sparse(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(text, feature, value) of all features found, and per text the
        number of words that have one, whole and by their largest share."""
        texts_of, feats, words = [], [], []
        for key, text, word in word_features(texts):
            at = self.index.find(key)
            hit = at >= 0
            texts_of.append(text[hit])
            feats.append(at[hit])
            words.append(word[hit])
        text, feature = np.concatenate(texts_of), np.concatenate(feats).astype(np.int64)
        found, first, at = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        share = np.zeros(len(found))
        np.maximum.at(share, at, self.share[feature])
        hits = np.bincount(text[first], minlength=len(texts))
        uses = np.bincount(text[first], weights=share, minlength=len(texts)).astype(np.float64)  # whole if empty
        order = np.lexsort((feature, text))
        text, feature = text[order], feature[order]
        head = runs(text, feature)
        n = np.diff(np.append(head, len(text)))
        return text[head], feature[head], np.log1p(n), hits, uses

    def linear(self, text: np.ndarray, feature: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(text, weights=self.weight[feature] * value, minlength=size)

    def above(self, s: np.ndarray) -> np.ndarray:
        """P(grade > j) for every j (rows x thresholds)."""
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.theta, -500, 500)))

    def fit(self, text, feature, value, grade: np.ndarray, steps: int = STEPS, rate: float = 0.1) -> None:
        size, cuts = len(grade), len(self.theta)
        toxic = grade > 0
        weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
        # theta_0, then logarithms of the steps up: the order can't break.
        cut = np.concatenate([[1.0], np.zeros(cuts - 1)])
        self.weight[:] = 1.0
        m = [np.zeros_like(self.weight), np.zeros_like(cut)]
        v = [np.zeros_like(self.weight), np.zeros_like(cut)]
        rows = np.arange(size)
        for step in range(1, steps + 1):
            gaps = np.exp(cut[1:])
            self.theta = cut[0] + np.concatenate([[0.0], np.cumsum(gaps)])
            up = np.column_stack([np.ones(size), self.above(self.linear(text, feature, value, size)), np.zeros(size)])
            hi, lo = up[rows, grade], up[rows, grade + 1]
            p = np.maximum(hi - lo, 1e-12)
            ds = -weight * (1 - hi - lo)
            dtheta = np.zeros(cuts + 2)
            np.add.at(dtheta, grade, weight * hi * (1 - hi) / p)
            np.add.at(dtheta, grade + 1, -weight * lo * (1 - lo) / p)
            dtheta = dtheta[1:-1]
            down = np.cumsum(dtheta[::-1])[::-1]
            grads = [
                np.bincount(feature, weights=ds[text] * value, minlength=len(self.weight)) + 1e-5 * self.weight,
                np.concatenate([[down[0]], down[1:] * gaps]),
            ]
            for i, (x, g) in enumerate(zip((self.weight, cut), grads, strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                x -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
        self.theta = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])


def _telling(counts: DataFrame, n0: int, n1: int) -> DataFrame:
    """Features that occur more in toxic documents than luck explains, all of
    them: they occur in the bounded sample twice at least."""
    total = counts.count()
    share = n1 / (n0 + n1)
    both = F.col("n0") + F.col("n1")
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    ratio = 2 * (term(F.col("n1"), both * share) + term(F.col("n0"), both * (1 - share)))
    level = 2 * np.log(max(total, 2)) + 2
    lift = ((F.col("n1") + 0.5) / (n1 + 1)) / ((F.col("n0") + 0.5) / (n0 + 1))
    kept = counts.withColumns({"g": ratio, "share": 1 - 1 / lift})
    return kept.where((F.col("share") > 0) & (F.col("n1") >= 2) & (F.col("g") >= level))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    keep: Column | None = None,
    per_class: int = PER_CLASS,
    levels: tuple[int, ...] = LEVELS,
) -> Ordinal:
    """Model from at most ``per_class`` documents of each label."""
    prepare(docs.sparkSession)
    sample = labelled_sample(labels, id_col, label_col, per_class, keep).checkpoint()
    chosen = docs.join(F.broadcast(sample), col(id_col) == sample["id"]).select(
        whole_text(text_col).alias("text"), "label"
    )
    grades = 2 + len(levels)
    sizes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Ordinal(np.zeros(0, U64), grades)
    counts = (
        chosen.mapInArrow(_feature_counts, "key long, n0 long, n1 long")
        .groupBy("key")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .checkpoint()
    )
    telling = _telling(counts, n0, n1).select("key", "share").toArrow().sort_by("key")
    model = Ordinal(telling.column("key").to_numpy().view(U64), grades, telling.column("share").to_numpy())
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                text, feature, value, _, uses = sent.value.sparse(piece.column(0))
                ends = np.searchsorted(text, np.arange(piece.num_rows + 1)).astype(np.int32)
                parts = np.bincount(text, weights=value * (1 + feature), minlength=piece.num_rows).astype(np.float64)
                yield pa.record_batch(
                    [
                        piece.column(1),
                        pa.array(uses),
                        pa.array(parts),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(feature)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(value)),
                    ],
                    names=["label", "uses", "sum", "features", "values"],
                )

    table = chosen.mapInArrow(rows, "label int, uses double, sum double, features array<long>, values array<double>").toArrow()
    table = table.sort_by([(c, "ascending") for c in ("label", "uses", "sum")])  # whatever order they came in
    label, uses = table.column("label").to_numpy(), table.column("uses").to_numpy()
    grade = np.where(label == 1, 1 + sum((uses >= n).astype(int) for n in levels), 0)
    # Flat arrays of the features found: twelve or sixteen bytes for each one in
    # the sample's texts.
    features = table.column("features").combine_chunks()
    text = np.repeat(np.arange(len(label)), features.value_lengths().to_numpy())
    feature = features.flatten().to_numpy()
    value = table.column("values").combine_chunks().flatten().to_numpy()
    model.fit(text, feature, value, grade)
    return model


def score(df: DataFrame, text_col: str, model: Ordinal) -> DataFrame:
    """All rows and columns of ``df`` with ``p_toxic`` (P(grade > 0)),
    ``expected_severity`` (0 to the highest grade), ``severity_grade`` (the
    number of thresholds passed with a probability of one half or more) and
    ``n_hits`` (words with a feature of the model)."""
    prepare(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("p_toxic double, expected_severity double, severity_grade int, n_hits long")
    def of(texts: pa.Array) -> pa.Array:
        m, parts = sent.value, []
        for piece in pieces(pa.record_batch([texts], names=["t"]), 0):
            text, feature, value, hits, _ = m.sparse(piece.column(0))
            up = m.above(m.linear(text, feature, value, piece.num_rows))
            parts.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array(up[:, 0]),
                        pa.array(up.sum(axis=1)),
                        pa.array((up >= 0.5).sum(axis=1).astype(np.int32)),
                        pa.array(hits.astype(np.int64)),
                    ],
                    names=["p_toxic", "expected_severity", "severity_grade", "n_hits"],
                )
            )
        return pa.concat_arrays(parts)

    new = ["p_toxic", "expected_severity", "severity_grade", "n_hits"]
    out = df.withColumn(OWN + "toxic", of(whole_text(text_col)))
    return out.select(*[col(c) for c in df.columns if c not in new], f"{OWN}toxic.*")
