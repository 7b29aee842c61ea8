"""Native vector functions on ``array<double>`` columns.

Everything here is a Catalyst expression (higher-order functions), so it runs
in the JVM without Python. Spark interprets higher-order functions (they are not
part of whole-stage code generation), so wide vectors take the Arrow path of
``operators.towers`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """row-wise dot product."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, t: s + t)


def vec_sum(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda s, t: s + t)


def checksum(v) -> Column:
    """Position-weighted sum ``sum_j (j+1) * v[j]``: one number that checks every element and its place."""
    weighted = F.transform(_c(v), lambda x, i: x * (i + F.lit(1)).cast("double"))
    return F.aggregate(weighted, F.lit(0.0), lambda s, t: s + t)


def sigmoid(z) -> Column:
    """F1."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def round_half_even(x) -> Column:
    """rounding to an integer with ties to even, like the tensor ``round``."""
    return F.rint(_c(x))


def as_double(x) -> Column:
    """label int -> double."""
    return _c(x).cast("double")


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def to_double_array(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def concat_features(*vs) -> Column:
    """concatenate the feature vectors of one tower (``cat`` along dim 1)."""
    return F.concat(*[_c(v) for v in vs])


def dense_layer(x, weights: Sequence[Sequence[float]], bias: Sequence[float], activation: str = "relu") -> Column:
    """``act(W x + b)`` with W given row-major as (out, in) literals.

    Suited to narrow layers; wide towers use the Arrow path in ``operators.towers``.
    """
    w = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in weights])
    b = F.array(*[F.lit(float(v)) for v in bias])
    xc = _c(x)
    pre = F.zip_with(w, b, lambda row, bj: dot(row, xc) + bj)
    if activation == "relu":
        return F.transform(pre, lambda z: F.greatest(z, F.lit(0.0)))
    if activation == "identity":
        return pre
    raise ValueError(activation)


def mlp(x, layers: Sequence[tuple], final_activation: str = "identity") -> Column:
    """stack of ``dense_layer``; ``layers`` = [(W, b), ...]. ReLU between layers."""
    out = _c(x)
    for k, (w, b) in enumerate(layers):
        act = "relu" if k < len(layers) - 1 else final_activation
        out = dense_layer(out, w, b, act)
    return out


def bce_with_logits(z, y) -> Column:
    """A6 per row: numerically stable binary cross-entropy on a logit."""
    zc, yc = _c(z), as_double(_c(y))
    return F.greatest(zc, F.lit(0.0)) - zc * yc + F.log1p(F.exp(-F.abs(zc)))
