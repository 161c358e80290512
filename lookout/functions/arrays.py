"""Vector functions over ARRAY columns (F3-F8, D5) as native higher-order
expressions: they run inside whole-stage codegen, no Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unit_scale(a, scale: float = 255.0) -> Column:
    """0..255 pixel values -> [0, 1] doubles."""
    return F.transform(_c(a), lambda x: x.cast("double") / F.lit(scale))


def pad_or_cut(a, n: int, fill=0) -> Column:
    """length exactly ``n``: a short vector is zero-padded at the tail, a
    long one is cut (the reference's guarded copy into a fixed tensor)."""
    a = _c(a)
    return F.slice(F.concat(a, F.array_repeat(F.lit(fill).cast(_elem_type_hint(fill)), n)), 1, n)


def _elem_type_hint(fill) -> str:
    return "double" if isinstance(fill, float) else "int"


def reshape(a, h: int, w: int, c: int) -> Column:
    """flat row-major vector -> nested ``h x w x c`` array (padded/cut to
    ``h*w*c`` first)."""
    flat = pad_or_cut(a, h * w * c)
    return F.transform(
        F.sequence(F.lit(0), F.lit(h - 1)),
        lambda r: F.transform(
            F.sequence(F.lit(0), F.lit(w - 1)), lambda col: F.slice(flat, (r * w + col) * c + 1, c)
        ),
    )


def argmax(scores) -> Column:
    """index of the largest score, the first one on ties."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def one_hot(label, k: int = 10) -> Column:
    """class index -> k-vector of 0.0 / 1.0."""
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == lab, 1.0).otherwise(0.0))


def softmax(scores) -> Column:
    """F8: numerically stable softmax (shifted by the maximum)."""
    s = F.transform(_c(scores), lambda x: x.cast("double"))
    m = F.array_max(s)
    e = F.transform(s, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def round_all(a, digits: int = 6) -> Column:
    return F.transform(_c(a), lambda x: F.round(x, digits))


def dot(a, w: Sequence[float] | Column) -> Column:
    """Sequential dot product of a numeric vector with a weight vector."""
    wc = F.array(*[F.lit(float(v)) for v in w]) if not isinstance(w, Column) else w
    return F.aggregate(F.zip_with(_c(a), wc, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda acc, v: acc + v)


# The deterministic linear stand-in model: weights ((7c + 3i) % 11 - 5) / 10 for
# class c and feature i, biases c / 100. They repeat after so many features.
RULE_PERIOD = 11


def linear_scores(x, k: int = 10) -> Column:
    """``k`` class scores ``sum_i x[i] * w[c][i] + b[c]`` of the
    rule-defined linear head, as pure expressions (any vector length). One
    period of each class's weights is a constant; it is repeated to the
    vector's length, and the two are multiplied pairwise."""
    period = F.array(
        *[
            F.array(*[F.lit(((7 * c + 3 * i) % RULE_PERIOD - 5) / 10.0) for i in range(RULE_PERIOD)])
            for c in range(k)
        ]
    )
    biases = F.array(*[F.lit(c / 100.0) for c in range(k)])
    size = F.size(_c(x))
    times = F.ceil(size / RULE_PERIOD).cast("int")

    def scores(v: Column) -> Column:  # v: the vector in double precision, made once
        sums = F.transform(period, lambda w: dot(v, F.slice(F.flatten(F.array_repeat(w, times)), 1, size)))
        return F.zip_with(sums, biases, lambda a, b: a + b)

    doubles = F.transform(_c(x), lambda v: v.cast("double"))
    return F.transform(F.array(doubles), scores)[0]
