"""Operator 11: embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Every entry c (as double) becomes the whole number x = floor(64 c) + 1000000. The method finds the leading
eigenvectors of x's covariance without ever forming it. It alternates the products X v and X'u over the centred rows:

    alpha_j u_j     = X v_j  - beta_{j-1} u_{j-1}
    beta_j  v_{j+1} = X'u_j  - alpha_j v_j

and a singular value decomposition of the small bidiagonal matrix (alpha on, beta above the diagonal) gives components
and deviations: X V = U B, B = P s Q', components = V Q, eigenvalues = s^2 / n. Both sequences are fully
reorthogonalised, twice per step.

* The vectors are packed once into a written table of blocks (64 vectors each, whole numbers in the smallest width that
  holds them exactly), so every product reads about a byte per entry; a lost executor costs one product's task.
* Counts, sums and sums of squares per dimension are exact (decimals), so the mean, the trace and ``deviation`` are.
* A step is one job. A left vector is a combination of the rows' columns, u_j = X a_j, so the driver holds only its
  ``dim`` coordinates a_j. A task computes its part of u = X a and at once X'u and |u|^2; the parts are summed by Spark.
  As u_i . u = a_i . (X'u), left vectors are reorthogonalised by their coordinates: no n-long vector is stored.
* Driver and broadcasts hold ``dim`` x ``dim`` numbers at most. Nothing is shuffled by key, so no key can be hot.
* Steps go on until ``k`` components are converged and the variance outside the searched space is below the k-th
  eigenvalue (so that no copy of a multiple eigenvalue is missed), or every dimension is searched. Where a sequence ends
  early, it goes on with a new vector orthogonal to the earlier ones.

Results for special cases: a vector that is null or empty, or holds null or non-finite entries, has no rows. If vectors
differ in length, the most frequent length counts (of equals the greatest); the others have no rows. Entries beyond
+-2**44 count as +-2**44 (beyond that no ``deviation`` fits a long). Repeated rows are rows of their own; a null id
stays null. A component whose deviation is under 1e-10 of the first one's cannot be whitened and is left out: equal
vectors, or a single one, give no rows. An empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, flat_numbers, written

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 50           # of floor(64 c): whole numbers that doubles hold, with room for sums
BLOCK = 64                  # vectors in a block
SLICE = 4096                # vectors that a task multiplies at a time
MIN_DEVIATION = 1e-10       # of the first component's deviation
WIDTHS = (1, 2, 4, 8)


@dataclass
class Whitening:
    """Fitted components: rows of ``components`` are unit vectors, by falling eigenvalue."""
    n: int
    dim: int
    sums: list[int]             # of floor(64 c), per dimension
    mean: np.ndarray
    residual: np.ndarray        # exact mean minus ``mean``
    trace: float
    components: np.ndarray
    eigenvalues: np.ndarray
    steps: int

    def projection(self) -> np.ndarray:
        return (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def pack_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The usable vectors as written blocks (dim, width, ids, data)."""
    src = columns(rows, id=id_col, vec=vec_col).withColumn("vec", F.col("vec").cast("array<double>"))
    id_type = src.schema["id"].dataType.simpleString()

    def fn(batches):
        for batch in batches:
            ids, vec = batch.column(0), batch.column(1)
            if not len(ids):
                continue
            offsets = np.asarray(vec.offsets).astype(np.int64)
            flat = np.asarray(pc.fill_null(vec.values, float("nan")), dtype=np.float64)
            lengths = np.where(np.asarray(vec.is_valid()), np.diff(offsets), 0)
            bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
            lengths[bad[offsets[1:]] > bad[offsets[:-1]]] = 0
            for dim in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == dim)
                y = np.floor(np.clip(flat[offsets[at][:, None] + np.arange(dim)], -LARGEST / SCALE, LARGEST / SCALE) * SCALE)
                yield _blocks(ids.take(pa.array(at)), y.astype(np.int64), id_type)

    out = src.mapInArrow(fn, f"dim int, width int, ids array<{id_type}>, data binary")
    return written(out, "whitening_blocks")


def _blocks(ids: pa.Array, y: np.ndarray, id_type: str) -> pa.RecordBatch:
    n, dim = y.shape
    cuts = np.r_[np.arange(0, n, BLOCK), n]
    widths, pieces = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        top = int(np.abs(y[lo:hi]).max())
        width = next(w for w in WIDTHS if top < 1 << (8 * w - 1))
        widths.append(width)
        pieces.append(y[lo:hi].astype(f"<i{width}").tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array([dim] * len(pieces), pa.int32()), pa.array(widths, pa.int32()),
         pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids), pa.array(pieces, pa.binary())],
        names=["dim", "width", "ids", "data"])


def _slices(batch: pa.RecordBatch, dim: int):
    """(block numbers, whole numbers as an n x dim matrix) of a batch, at most about ``SLICE`` vectors at a time."""
    width = np.asarray(batch.column("width"))
    data = batch.column("data")
    for w in WIDTHS:
        at = np.flatnonzero(width == w)
        step = max(1, SLICE // BLOCK)
        for lo in range(0, len(at), step):
            some = at[lo:lo + step]
            flat, _ = flat_numbers(data.take(pa.array(some)), f"<i{w}")
            yield some, flat.reshape(-1, dim).astype(np.int64)


def vector_stats(blocks: DataFrame) -> DataFrame:
    """(dim, pos, n, total, squares) with exact sums of the whole numbers, per length and dimension."""
    def fn(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                for _, y in _slices(batch.take(pa.array(np.flatnonzero(dims == dim))), int(dim)):
                    n, total, squares = sums.get(dim, (0, 0, 0))
                    exact = y if np.abs(y).max() < 1 << 24 else y.astype(object)     # 4096 squares fit 61 bits
                    sums[dim] = (n + len(y), total + y.sum(axis=0).astype(object), squares + (exact * exact).sum(axis=0).astype(object))
        for dim, (n, total, squares) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                 pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                 pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0))],
                names=["dim", "pos", "n", "total", "squares"])

    parts = blocks.select("dim", "width", "data").mapInArrow(fn, "dim int, pos int, n long, total decimal(38,0), squares decimal(38,0)")
    return parts.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], dim: int, size: int) -> np.ndarray:
    """Sum of ``part`` (numbers, ``size`` of them) over all slices: one row per task, added up by Spark."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    def fn(batches):
        total = np.zeros(size)
        for batch in batches:
            for _, y in _slices(batch, dim):
                total += part(y)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

    parts = blocks.select("width", "data").mapInArrow(fn, "part array<double>")
    return parts.agg(Summarizer.sum(array_to_vector("part")).alias("s")).first()["s"].toArray()


def fit_whitening(blocks: DataFrame, k: int = 32, seed: int = 0) -> tuple[DataFrame, Whitening] | None:
    """The blocks of the counted length, and up to ``k`` fitted components; None if no vector is usable."""
    lengths = vector_stats(blocks)
    lengths = written(lengths, "whitening_stats")
    top = lengths.where(F.col("pos") == 0).orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        return None
    dim, n = int(top["dim"]), int(top["n"])
    rows = lengths.where(F.col("dim") == dim).orderBy("pos").collect()      # one per dimension
    sums, squares = [int(r["total"]) for r in rows], [int(r["squares"]) for r in rows]
    blocks = blocks.where(F.col("dim") == dim)
    exact = [Fraction(s, n) for s in sums]
    mean = np.array([float(f) for f in exact])
    residual = np.array([float(f - Fraction(m)) for f, m in zip(exact, mean.tolist())])
    trace = float(Fraction(sum(n * q - s * s for q, s in zip(squares, sums)), n * n))
    fitted = Whitening(n, dim, sums, mean, residual, trace, np.zeros((0, dim)), np.zeros(0), 0)
    if trace > 0:
        def products(a: np.ndarray) -> tuple[np.ndarray, float]:
            def part(y):
                centred = y - mean
                u = centred @ a
                return np.r_[u @ centred, u @ u]
            out = _summed(blocks, part, dim, dim + 1)
            return out[:dim], float(out[dim])

        values, vectors, fitted.steps = bidiagonalise(products, dim, trace * n, k, seed)
        keep = values > MIN_DEVIATION * values[0]
        fitted.eigenvalues, fitted.components = values[keep] ** 2 / n, vectors[keep]
    return blocks, fitted


def bidiagonalise(products: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, energy: float, k: int, seed: int = 0
                  ) -> tuple[np.ndarray, np.ndarray, int]:
    """Leading ``k`` singular values and right singular vectors (rows) of X, and the number of steps.

    ``products(a)`` returns X'(X a) and |X a|^2; ``energy`` is the sum of X's squared entries.
    """
    rng = np.random.default_rng(seed)
    tiny = 1e-13 * np.sqrt(energy)
    right, coords, images = np.zeros((0, dim)), np.zeros((0, dim)), np.zeros((0, dim))     # v_j, a_j, X'u_j
    alpha, beta = [], []

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - (right @ v) @ right
        return v

    v = rng.standard_normal(dim)
    v /= np.linalg.norm(v)
    for j in range(dim):
        right = np.vstack([right, v])
        a = v - beta[-1] * coords[-1] if j else v
        image, square = products(a)
        for _ in range(2):                                  # u_i . u = a_i . X'u
            c = coords @ image
            a, image, square = a - c @ coords, image - c @ images, square - c @ c
        size = np.sqrt(max(square, 0.0))
        size = size if size > tiny else 0.0
        alpha.append(size)
        coords = np.vstack([coords, a / size if size else 0 * a])
        images = np.vstack([images, image / size if size else 0 * image])
        v = orthogonal(images[-1] - size * v)
        beta.append(float(np.linalg.norm(v)))
        if beta[-1] <= tiny:                                # the sequence ended: go on with a new direction
            beta[-1] = 0.0
            v = orthogonal(rng.standard_normal(dim))
        size = np.linalg.norm(v)
        if j + 1 == dim or size == 0.0:
            break
        v /= size
        if j + 1 >= k and _converged(alpha, beta, energy, k):
            break
    left, values, small = np.linalg.svd(np.diag(alpha) + np.diag(beta[:-1], 1))
    vectors = (small @ right)[:k]
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values[:k], vectors * sign[:, None], len(alpha)


def _converged(alpha: list[float], beta: list[float], energy: float, k: int) -> bool:
    b = np.diag(alpha) + np.diag(beta[:-1], 1)
    left, values, _ = np.linalg.svd(b)
    outside = energy - float((b * b).sum())
    return bool(np.all(beta[-1] * np.abs(left[-1, :k]) <= 1e-14 * values[0]) and outside < values[k - 1] ** 2)


def identity_error(blocks: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance (centred, divisor n) minus the identity."""
    k = len(fitted.eigenvalues)
    mean, w = fitted.mean, fitted.projection()
    offset = fitted.residual @ w

    def part(y):
        z = (y - mean) @ w - offset
        return (z.T @ z).ravel()

    cov = _summed(blocks, part, fitted.dim, k * k).reshape(k, k) / fitted.n
    return float(np.abs(cov - np.eye(k)).max())


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S)^2 of every row, exact. The offset of x cancels out."""
    bound = n * int(np.abs(y).max()) + max(abs(s) for s in sums)
    kind = np.int64 if bound * bound * y.shape[1] < 1 << 63 else object
    d = y.astype(kind) * n - np.array(sums, dtype=kind)
    return (d * d).sum(axis=1).tolist()


def whiten(blocks: DataFrame, fitted: Whitening) -> DataFrame:
    """A row per vector and component: vec_id, component, deviation, whitened, explained."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    dim, n, sums, mean, w = fitted.dim, fitted.n, fitted.sums, fitted.mean, fitted.projection()
    k = w.shape[1]
    explained = fitted.eigenvalues / fitted.trace

    def fn(batches):
        for batch in batches:
            ids = batch.column("ids")
            for some, y in _slices(batch, dim):
                own = ids.take(pa.array(some)).flatten()
                rows = np.repeat(np.arange(len(own)), k)
                dev = [Decimal(d) if d < 10 ** 38 else None for d in deviations(y, n, sums)]
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(own)), pa.int32()),
                     pa.array(dev, pa.decimal128(38, 0)).take(pa.array(rows)), pa.array(((y - mean) @ w).ravel()),
                     pa.array(np.tile(explained, len(own)))],
                    names=["vec_id", "component", "deviation", "whitened", "explained"])

    return blocks.select("width", "ids", "data").mapInArrow(
        fn, f"vec_id {id_type}, component int, deviation decimal(38,0), whitened double, explained double")


def whitened_rows(rows: DataFrame, k: int = 32, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 0) -> DataFrame:
    """Whitened components of every usable vector, with the number of vectors and the measured identity error."""
    id_type = rows.schema[id_col].dataType.simpleString()
    fit = fit_whitening(pack_vectors(rows, id_col, vec_col), k, seed)
    if fit is None or not len(fit[1].eigenvalues):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    blocks, fitted = fit
    return whiten(blocks, fitted).select(
        "vec_id", "component", F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(identity_error(blocks, fitted)).alias("identity_error"))
