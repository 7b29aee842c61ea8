"""Training of the factorisation machine (R3) whose coefficients no single process holds.

The same arithmetic as Spark ML's ``FMClassifier`` on one-hot user and item vectors: full gradients, AdamW, the initial factors of
its random numbers (``java.util.Random``), its stopping rule. Coefficients and moments are kept in the shared scratch folder as
slices of ``SLICE_IDS`` ids of one side, a row of (coefficients, moments) per slice. Rows are written once, dealt to pieces by
ranges of users (a range with many rows is cut into several) and sorted by item.

An iteration has two jobs:
1. a piece takes its users' slices, and with its rows the items' slices in order; it writes the gradient sums of the ids it met, by slice;
2. a task takes some slices, adds up their gradients, makes the step and writes the new slices.
The driver keeps the intercept, and per iteration reads two rows of sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.functions.gradients import sigmoid_np
from duotower.operators.lookup import embedding_lookups
from duotower.operators.towers import _arrow_lists
from duotower.session import new_run_id, scratch_path
from duotower.sources.model_store import _delete

SLICE_IDS = 4096
TASK_BYTES = 64 << 20           # of the slices that a task holds
INIT_STD, TOL = 0.01, 1e-6      # defaults of Spark ML
BETAS, EPS = (0.9, 0.999), 1e-8
ATTEMPTS = 1 << 16              # pairs of random numbers that are made at once

_STEP = "side int, slice long, params binary, m binary, v binary, moved double, norm double"
_GRADS = "side int, slice long, at binary, grad binary, residual double"


# ------------------------------------------------------------------ Java's random numbers

_A, _C, _MASK = 0x5DEECE66D, 0xB, (1 << 48) - 1


def _skip(state: int, n: int) -> int:
    """The generator's state ``n`` steps later."""
    a, c, total_a, total_c = _A, _C, 1, 0
    while n:
        if n & 1:
            total_a, total_c = total_a * a & _MASK, (total_c * a + c) & _MASK
        a, c, n = a * a & _MASK, (c * a + c) & _MASK, n >> 1
    return (total_a * state + total_c) & _MASK


def _states(state: int, n: int) -> np.ndarray:
    """The ``n`` states after ``state``."""
    a, c = np.array([_A], np.uint64), np.array([_C], np.uint64)
    while len(a) < n:       # the maps of k + 1 to 2k steps from those of 1 to k
        a, c = np.concatenate([a, a * a[-1]]), np.concatenate([c, a * c[-1] + c])
    return (a[:n] * np.uint64(state) + c[:n]) & np.uint64(_MASK)


def _pairs(seed: int, first: int, n: int) -> np.ndarray:
    """``java.util.Random.nextGaussian``'s attempts ``first`` to ``first + n - 1``: pairs of those that it takes."""
    x = _states(_skip((seed ^ _A) & _MASK, 4 * first), 4 * n).reshape(n, 2, 2)
    unit = ((x[:, :, 0] >> np.uint64(22)) * np.uint64(1 << 27) + (x[:, :, 1] >> np.uint64(21))).astype(np.float64) * 2.0 ** -53
    v = 2 * unit - 1
    s = v[:, 0] * v[:, 0] + v[:, 1] * v[:, 1]
    v, s = v[(s < 1) & (s != 0)], s[(s < 1) & (s != 0)]
    return v * np.sqrt(-2 * np.log(s) / s)[:, None]


def _taken(spark: SparkSession, seed: int, n_pairs: int) -> np.ndarray:
    """Pairs taken before each ``ATTEMPTS`` attempts, up to those that hold ``n_pairs``."""
    found = [0]
    while found[-1] < n_pairs:
        begin, more = len(found) - 1, max(1, math.ceil(1.3 * (n_pairs - found[-1]) / ATTEMPTS))

        def count(batches):
            for batch in batches:
                at = batch.column("id").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([len(_pairs(seed, k * ATTEMPTS, ATTEMPTS)) for k in at])], names=["k", "n"])

        parts = min(more, 2 * spark.sparkContext.defaultParallelism)
        rows = spark.range(begin, begin + more, 1, parts).mapInArrow(count, "k long, n long").collect()      # one per 2^16 attempts
        found += (found[-1] + np.cumsum([r["n"] for r in sorted(rows)])).tolist()
    return np.array(found)


def gaussians(seed: int, taken: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The numbers ``lo`` to ``hi - 1`` of ``nextGaussian``."""
    first, last = lo // 2, (hi + 1) // 2
    k = int(np.searchsorted(taken, first, "right")) - 1
    begin, parts = int(taken[k]), []
    while taken[k] < last:
        parts.append(_pairs(seed, k * ATTEMPTS, ATTEMPTS))
        k += 1
    flat = np.concatenate(parts).ravel() if parts else np.empty(0)
    return flat[lo - 2 * begin:hi - 2 * begin]


# ------------------------------------------------------------------ slices

def _stored(path: str, columns: list[str], side: int, lo: int, hi: int):
    """In a task: rows of the slices ``lo`` to ``hi - 1`` of a side, in order of the files."""
    if path.startswith("file:") and "://" not in path:
        path = path[len("file:"):]
    fs, base = pafs.FileSystem.from_uri(path)
    schema = pa.schema({"side": pa.int32(), "slice": pa.int64(), **{c: pa.binary() for c in ("params", "m", "v", "at", "grad")}})
    wanted = (ds.field("side") == side) & (ds.field("slice") >= lo) & (ds.field("slice") < hi)
    found = ds.dataset(base, schema=schema, filesystem=fs, format="parquet")
    for batch in found.to_batches(columns=["slice", *columns], filter=wanted, batch_size=16, batch_readahead=1, fragment_readahead=1, use_threads=False):
        for row in zip(*(batch.column(c).to_pylist() for c in range(1 + len(columns)))):
            yield row


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, width)


@dataclass
class FMTables:
    """A fitted model: its slices' folder, the ids and the intercept."""

    path: str
    sizes: list
    factor_size: int
    intercept: float
    slice_ids: int

    def table(self, spark: SparkSession, side: int) -> DataFrame:
        """(bucket, vec) of a side: the linear weight, then the factors."""
        width, path, ids = self.factor_size + 1, self.path, self.slice_ids
        n = math.ceil(self.sizes[side] / ids)

        def rows(batches):
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    for s, data in _stored(path, ["params"], side, k, k + 1):
                        x = _matrix(data, width)
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(s * ids, s * ids + len(x))), _arrow_lists(x)], names=["bucket", "vec"])

        parts = max(1, min(n, 2 * spark.sparkContext.defaultParallelism))
        return spark.range(0, n, 1, parts).mapInArrow(rows, "bucket long, vec array<double>")

    def raw(self, df: DataFrame, cols: tuple) -> DataFrame:
        """``df`` with ``raw``, the model's value for its ids; ids that training did not see add nothing."""
        spark = df.sparkSession
        sides = [(c, self.table(spark, k), f"_x{k}") for k, c in enumerate(cols)]
        x = embedding_lookups(df, sides, self.factor_size + 1, [max(1, n) for n in self.sizes])
        u, i = F.col("_x0"), F.col("_x1")
        pair = F.aggregate(F.zip_with(u, i, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p) - u[0] * i[0]
        return x.withColumn("raw", F.lit(self.intercept) + u[0] + i[0] + pair).drop("_x0", "_x1")


# ------------------------------------------------------------------ an iteration

def _gradients(rows: str, piece: tuple, params: str, counts: list[int], slice_ids: int, width: int, intercept: float, batch_rows: int):
    """Step 1 for a piece (number, first slice of its users, end)."""
    number, lo, hi = piece
    users = np.zeros(((hi - lo) * slice_ids, width))
    for s, data in _stored(params, ["params"], 0, lo, hi):
        x = _matrix(data, width)
        users[(s - lo) * slice_ids:(s - lo) * slice_ids + len(x)] = x
    sums, met = np.zeros_like(users), np.zeros(len(users), bool)
    if rows.startswith("file:") and "://" not in rows:
        rows = rows[len("file:"):]
    fs, base = pafs.FileSystem.from_uri(rows)
    found = ds.dataset(f"{base}/_piece={number}", schema=pa.schema({"u": pa.int64(), "i": pa.int64(), "y": pa.float64()}), filesystem=fs, format="parquet")
    items = _stored(params, ["params"], 1, 0, counts[1])
    at, held, residual = -1, None, 0.0       # the slice of items at hand
    for batch in found.to_batches(batch_size=batch_rows, batch_readahead=1, fragment_readahead=1, use_threads=False):
        u, i, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        home = i // slice_ids
        cuts = np.flatnonzero(np.diff(home)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(home)] if len(home) else []):
            while at != home[a]:
                at, data = next(items)
                held = _matrix(data, width)
            ru, ri = u[a:b] - lo * slice_ids, i[a:b] - at * slice_ids
            xu, xi = users[ru], held[ri]
            raw = intercept + xu[:, 0] + xi[:, 0] + np.einsum("ij,ij->i", xu[:, 1:], xi[:, 1:])
            off = sigmoid_np(raw) - y[a:b]
            residual += float(off.sum())
            xu[:, 0] = xi[:, 0] = 1.0       # a weight's gradient; a factor's is the other side's
            xu *= off[:, None]
            xi *= off[:, None]
            met[ru] = True
            _add(sums, ru, xi)
            ids, inverse = np.unique(ri, return_inverse=True)
            grad = np.zeros((len(ids), width))
            _add(grad, inverse, xu)
            yield _grad_rows(1, at, ids, grad)
    for k in range(lo, hi):
        part = slice((k - lo) * slice_ids, (k - lo + 1) * slice_ids)
        ids = np.flatnonzero(met[part])
        if len(ids):
            yield _grad_rows(0, k, ids, sums[part][ids])
    yield _grad_rows(-1, -1, np.empty(0), np.empty(0), residual)


def _add(sums: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds ``rows`` to the rows ``at`` of ``sums``, which may be named several times."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    cut = np.flatnonzero(np.r_[True, np.diff(at) != 0])
    sums[at[cut]] += np.add.reduceat(rows[order], cut, axis=0)


def _grad_rows(side: int, k: int, ids: np.ndarray, grad: np.ndarray, residual: float | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([side], pa.int32()), pa.array([k], pa.int64()), pa.array([ids.astype(np.int32).tobytes()]), pa.array([grad.tobytes()]),
         pa.array([residual], pa.float64())], names=["side", "slice", "at", "grad", "residual"])


def _adamw(x, m, v, g, lr: float, t: int):
    m = BETAS[0] * m + (1 - BETAS[0]) * g
    v = BETAS[1] * v + (1 - BETAS[1]) * (g * g)
    return x - lr * (m / (1 - BETAS[0] ** t)) / (np.sqrt(v / (1 - BETAS[1] ** t)) + EPS), m, v


def _step(params: str, grads: str, side: int, lo: int, hi: int, width: int, n_rows: int, lr: float, t: int):
    """Step 2 for the slices ``lo`` to ``hi - 1`` of a side."""
    sums: dict[int, list] = {}
    for s, at, grad in _stored(grads, ["at", "grad"], side, lo, hi):
        at, grad = np.frombuffer(at, dtype=np.int32), _matrix(grad, width)
        if s not in sums:
            sums[s] = np.zeros((0, width))
        if len(at) and at[-1] >= len(sums[s]):
            sums[s] = np.vstack([sums[s], np.zeros((int(at[-1]) + 1 - len(sums[s]), width))])
        sums[s][at] += grad
    for s, data, m, v in _stored(params, ["params", "m", "v"], side, lo, hi):
        x = _matrix(data, width)
        g = np.zeros_like(x)
        if s in sums:
            got = sums.pop(s)
            g[:len(got)] = got / n_rows
        new, m, v = _adamw(x, _matrix(m, width) if m else np.zeros_like(x), _matrix(v, width) if v else np.zeros_like(x), g, lr, t)
        yield _slice_row(side, s, new, m.tobytes(), v.tobytes(), float(((new - x) ** 2).sum()))


def _slice_row(side: int, s: int, x: np.ndarray, m: bytes, v: bytes, moved: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([side], pa.int32()), pa.array([s], pa.int64()), pa.array([x.tobytes()]), pa.array([m]), pa.array([v]), pa.array([moved]),
         pa.array([float((x * x).sum())])], names=["side", "slice", "params", "m", "v", "moved", "norm"])


def fit_tables(rows: DataFrame, sizes: list[int], factor_size: int, max_iter: int, step_size: float, seed: int, slice_ids: int = SLICE_IDS,
               batch_rows: int = 131_072) -> FMTables:
    """The model of ``rows`` (u, i, y): ids below ``sizes`` and labels 0 and 1."""
    spark = rows.sparkSession
    root, width, cores = scratch_path(spark, "fm", new_run_id()), factor_size + 1, spark.sparkContext.defaultParallelism
    counts = [math.ceil(n / slice_ids) for n in sizes]
    per_block = max(1, min(math.ceil(counts[0] / cores), TASK_BYTES // (2 * slice_ids * width * 8)))        # slices of a range of users
    block = F.floor(F.col("u") / F.lit(per_block * slice_ids)).cast("int")
    found = {r["_b"]: r["count"] for r in rows.groupBy(block.alias("_b")).count().collect()}        # a row per range
    n_rows = sum(found.values())
    most = max(1, math.ceil(1.5 * n_rows / cores))
    plan, pieces = [], []
    for b in sorted(found):
        cuts = math.ceil(found[b] / most)
        plan.append((b, len(pieces), cuts))
        pieces += [(len(pieces) + k, b * per_block, min((b + 1) * per_block, counts[0])) for k in range(cuts)]
    piece = (F.col("_first") + F.pmod(F.monotonically_increasing_id(), F.col("_cuts"))).cast("int")
    (rows.withColumn("_b", block).join(F.broadcast(spark.createDataFrame(plan, "_b int, _first int, _cuts int")), "_b")
     .select("u", "i", F.col("y").cast("double").alias("y"), piece.alias("_piece")).repartitionById(len(pieces), "_piece")
     .sortWithinPartitions("_piece", "i", "u").write.option("compression", "zstd").partitionBy("_piece").parquet(f"{root}/rows"))

    tasks = []      # (side, first slice, end)
    for side, n in enumerate(counts):
        parts = max(1, min(n, cores), math.ceil(n * slice_ids * width * 8 * 4 / TASK_BYTES))
        tasks += [(side, n * k // parts, n * (k + 1) // parts) for k in range(parts)]

    def run(fn, todo: list, schema: str, path: str) -> DataFrame:
        def body(batches):
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    yield from fn(todo[k])

        spark.range(0, len(todo), 1, len(todo)).mapInArrow(body, schema).write.option("compression", "zstd").option(
            "parquet.block.size", TASK_BYTES // 4).parquet(path)
        return spark.read.schema(schema).parquet(path)

    taken = _taken(spark, seed, math.ceil(sum(sizes) * factor_size / 2))

    def first(task):
        side, lo, hi = task
        for s in range(lo, hi):
            a, b = s * slice_ids, min((s + 1) * slice_ids, sizes[side])
            before = side * sizes[0]
            x = np.zeros((b - a, width))
            x[:, 1:] = gaussians(seed, taken, (before + a) * factor_size, (before + b) * factor_size).reshape(-1, factor_size) * INIT_STD
            yield _slice_row(side, s, x, b"", b"", 0.0)

    run(first, tasks, _STEP, f"{root}/params=0")
    b = b_m = b_v = 0.0
    for t in range(1, max_iter + 1):
        params, grads = f"{root}/params={t - 1}", f"{root}/grads={t}"
        residual = run(lambda p, params=params, b=b: _gradients(f"{root}/rows", p, params, counts, slice_ids, width, b, batch_rows),
                       pieces, _GRADS, grads).agg(F.sum("residual")).first()[0]
        moved, norm = run(lambda task, params=params, grads=grads, t=t: _step(params, grads, *task, width, n_rows, step_size, t),
                          tasks, _STEP, f"{root}/params={t}").agg(F.sum("moved"), F.sum("norm")).first()
        b_old = b
        b, b_m, b_v = (float(x) for x in _adamw(b, b_m, b_v, residual / n_rows, step_size, t))
        for path in (params, grads):
            _delete(spark, path)
        if t > 1 and math.sqrt(moved + (b - b_old) ** 2) < TOL * max(math.sqrt(norm + b * b), 1.0):
            break
    _delete(spark, f"{root}/rows")
    return FMTables(f"{root}/params={t}", sizes, factor_size, b, slice_ids)
