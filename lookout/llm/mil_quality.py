"""Document quality by attention-based multiple-instance learning (operator 10).

A document is a bag of passages of ``PASSAGE`` words. Every passage is
measured and encoded, ``h = tanh(x W + b)``; gated attention weighs the
passages of a document,

    a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))),   z = sum_k a_k h_k,

and the document's score is ``sigmoid(c . z + d)``. Only the document's label
is needed: attention learns which passages decide. All parameters are fitted
together by Adam on a bounded sample of labelled documents (``PER_CLASS`` of
each label and ``MOST_PASSAGES`` passages of them, each with all its passages: bounds of the
training only). Scoring covers every passage of every document.

Features of a passage come from its words alone (shares of symbols, capitals,
digits, repeated words, word lengths, hashed word classes); no id, source,
language or label is an input.

Defined cases: a null or empty text is one passage without words; rows
without a label are only scored; without any labelled rows every score is
0.5; repeated rows are scored each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text
from lookout.llm.samples import labelled_sample
from lookout.llm.words import U64, Powers, Words, drop_idle, find_words, mix, pieces, range_hash

PASSAGE = 50
# Bytes of texts measured at once (one text at least); their features' scratch
# takes about thirty times as much.
MEASURED = 512 * 1024
PER_CLASS = 4000
# Passages of the training documents of one label; beyond, there are fewer documents.
MOST_PASSAGES = 1 << 18
# Passages (and the rest of the last bag) of one slice of a training step.
SLICE = 1 << 14
HIDDEN = 16
ATTENTION = 8
STEPS = 400
HASHED = 16
_PAIR = Powers(0x8EBC6AF09C88C6E3)


def _classes() -> np.ndarray:
    """Byte classes whose shares are features."""
    byte = np.arange(256)
    groups = [
        (byte >= 65) & (byte <= 90),
        (byte >= 97) & (byte <= 122),
        (byte >= 48) & (byte <= 57),
        byte >= 128,
        np.isin(byte, list(b"#*$%&<>")),
        byte == ord("|"),
        byte == ord("!"),
        np.isin(byte, list(b".,;:?")),
        np.isin(byte, list(b"()[]{}/\\_=+@~^`'\"-")),
    ]
    return np.stack(groups)


CLASSES = _classes()


def _repeats(keys: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Per owner, how many keys it has more than once (first not counted)."""
    order = np.argsort(mix(keys) ^ mix(owner + 1))
    k, o = keys[order], owner[order]
    same = np.zeros(len(k), dtype=bool)
    same[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[same], minlength=size)


def passages(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end word) of each passage; a text without words has
    one empty passage, and a short rest belongs to the passage before it."""
    n = w.counts()
    parts = np.maximum(1, (n + PASSAGE // 2) // PASSAGE)
    text = np.repeat(np.arange(len(n)), parts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = w.first[text] + k * PASSAGE
    last = np.where(k == parts[text] - 1, w.first[text + 1], first + PASSAGE)
    return text, first, last


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, passages x features)."""
    text, first, last = passages(w)
    size = len(text)
    n = (last - first).astype(np.float64)
    of = np.repeat(np.arange(size), last - first)
    safe = np.maximum(n, 1)
    length = (w.end - w.start).astype(np.float64)
    some = n > 0

    def ratio(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=values, minlength=size) / safe

    out = [some.astype(float), np.minimum(n, 100) / 100, ratio(length) / 8, np.sqrt(ratio(length**2)) / 8]
    total = np.maximum(np.bincount(of, weights=length, minlength=size), 1)
    for group in CLASSES:
        count = np.concatenate([[0], np.cumsum(group[w.buf], dtype=np.int64)])
        each = (count[w.end] - count[w.start]).astype(np.float64)
        out.append(np.bincount(of, weights=each, minlength=size) / total)
        out.append(ratio(each > 0))
    out.append(ratio(length <= 2))
    out.append(ratio(length >= 12))
    upto = w.buf[np.minimum(w.end - 1, len(w.buf) - 1)] if len(w.buf) else np.zeros(0, np.uint8)
    out.append(ratio(np.isin(upto, list(b".!?"))))
    again = np.zeros(len(w.hash))
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    out.append(ratio(again))
    out.append(_repeats(w.hash, of, size) / safe)
    at = np.flatnonzero(of[1:] == of[:-1])
    out.append(_repeats(range_hash(w.hash, at, at + 2, _PAIR), of[at], size) / safe)
    # Shares of hashed word classes: which words, not only which signs.
    bin_of = of * HASHED + (w.hash % U64(HASHED)).astype(np.int64)
    bins = np.bincount(bin_of, minlength=size * HASHED).reshape(size, HASHED) / safe[:, None]
    return text, np.column_stack([*out, bins]).astype(np.float32)


class Attention:
    """Parameters and their use; natural order of the forward pass."""

    def __init__(self, dims: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        small = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.mean, self.scale = np.zeros(dims), np.ones(dims)
        self.p = {
            "W": small(dims, HIDDEN),
            "b": np.zeros(HIDDEN),
            "V": small(HIDDEN, ATTENTION),
            "U": small(HIDDEN, ATTENTION),
            "w": small(ATTENTION),
            "c": np.zeros(HIDDEN),
            "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        """x: passages x features; bag: ascending bag index of each passage."""
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        head = np.searchsorted(bag, np.arange(bags))
        e = np.exp(e - np.maximum.reduceat(e, head)[bag])
        a = e / np.add.reduceat(e, head)[bag]
        z = np.add.reduceat(a[:, None] * h, head, axis=0)
        s = 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "s": s}

    def gradient(self, f: dict, bag: np.ndarray, ds: np.ndarray) -> dict[str, np.ndarray]:
        """Of a loss whose derivative by each bag's logit is ``ds``; ``f`` is
        the forward pass."""
        p = self.p
        dz = ds[:, None] * p["c"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        head = np.searchsorted(bag, np.arange(len(ds)))
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, head)[bag])
        gate = de[:, None] * p["w"]
        dt, dg = gate * f["g"] * (1 - f["t"] ** 2), gate * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ du,
            "b": du.sum(axis=0),
            "V": f["h"].T @ dt,
            "U": f["h"].T @ dg,
            "w": (f["t"] * f["g"]).T @ de,
            "c": f["z"].T @ ds,
            "d": np.array([ds.sum()]),
        }

    def fit(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.03) -> None:
        """Bags are taken through in slices of about ``SLICE`` passages, whose
        gradients are added up, so that only the passages' features themselves
        (in single precision) are held whole."""
        ends = np.searchsorted(bag, np.arange(len(y) + 1))
        cuts = np.unique(np.searchsorted(ends, np.arange(0, len(x) + SLICE, SLICE)).clip(max=len(y)))
        slices = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        self.mean = x.mean(axis=0, dtype=np.float64)
        off = sum(((x[ends[i] : ends[j]] - self.mean) ** 2).sum(axis=0) for i, j in slices)
        self.scale = np.sqrt(off / len(x)) + 1e-3
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            p, total = self.p, {k: 1e-4 * v for k, v in self.p.items()}
            for i, j in slices:
                own = bag[ends[i] : ends[j]] - i
                f = self.forward(x[ends[i] : ends[j]].astype(np.float64), own, j - i)
                for k, g in self.gradient(f, own, weight[i:j] * (f["s"] - y[i:j])).items():
                    total[k] = total[k] + g
            for k, g in total.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-9)


def _bags(batches):
    """(text, label, draw) -> (label, draw, number of passages, the features of all of them as bytes)."""
    drop_idle()
    for batch in batches:
        for piece in pieces(batch, 0, MEASURED):
            text, x = features(find_words(piece.column(0)))
            ends = np.searchsorted(text, np.arange(piece.num_rows + 1))
            rows = [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch(
                [piece.column(1), piece.column(2), pa.array(np.diff(ends)), pa.array(rows, pa.binary())],
                names=["label", "draw", "n", "x"],
            )


def _within(bags: DataFrame, most: int) -> Column:
    """The documents of each label, in the order of ``draw``, that have
    ``most`` passages together; one draw at least."""
    sizes = bags.select("label", "draw", "n").toArrow().sort_by([("label", "ascending"), ("draw", "ascending")])
    label, draw, n = (sizes.column(c).to_numpy() for c in ("label", "draw", "n"))
    kept = F.lit(False)
    for one in np.unique(label):
        mine = draw[label == one]
        last = max(1, int(np.searchsorted(np.cumsum(n[label == one]), most, side="right")))
        kept = kept | ((F.col("label") == int(one)) & (F.col("draw") <= int(mine[last - 1])))
    return kept


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    keep: Column | None = None,
    per_class: int = PER_CLASS,
) -> Attention:
    """Model from at most ``per_class`` documents of each label, each with all
    its passages."""
    prepare(docs.sparkSession)
    sample = labelled_sample(labels, id_col, label_col, per_class, keep)
    chosen = docs.join(F.broadcast(sample), col(id_col) == sample["id"]).select(
        whole_text(text_col).alias("text"), "label", F.xxhash64(sample["id"], F.lit(29)).alias("draw")
    )
    bags = chosen.mapInArrow(_bags, "label int, draw long, n long, x binary").checkpoint()
    table = bags.where(_within(bags, MOST_PASSAGES)).select("label", "x").toArrow()
    dims = features(find_words(pa.array([""])))[1].shape[1]
    model = Attention(dims)
    y = table.column("label").to_numpy().astype(np.float64)
    if len(y):
        blobs = table.column("x").to_pylist()
        order = np.array(sorted(range(len(y)), key=lambda i: (y[i], blobs[i])))  # whatever order they came in
        xs = [np.frombuffer(blobs[i], np.float32).reshape(-1, dims) for i in order]
        bag = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
        model.fit(np.concatenate(xs), bag, y[order])
    return model


def _scores(texts: pa.Array, model: Attention) -> pa.Array:
    """Score of each text."""
    drop_idle()
    parts = []
    for piece in pieces(pa.record_batch([texts], names=["t"]), 0, MEASURED):
        text, x = features(find_words(piece.column(0)))
        parts.append(model.forward(x, text, piece.num_rows)["s"])
    return pa.array(np.concatenate(parts) if parts else np.zeros(0))


def score(df: DataFrame, text_col: str, model: Attention) -> DataFrame:
    """All rows and columns of ``df`` with ``score`` (0 to 1)."""
    prepare(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return _scores(texts, sent.value)

    return df.withColumn(OWN + "score", of(whole_text(text_col))).select(
        *[col(c) for c in df.columns if c != "score"], F.col(OWN + "score").alias("score")
    )
