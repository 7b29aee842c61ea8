"""Two-tower model pieces: parameter init (M1), tower forward (F5/F6, M2), pair scores.

Parameters:
  * two embedding tables as DataFrames ``(bucket long, vec array<double>, g2 double)``;
    they grow with the number of users/items and are never collected;
  * two small MLPs (one per side) as NumPy arrays, size fixed by the config
    (49,536 numbers at the default sizes), shipped to executors as a broadcast.

A tower is applied to the *table* rows once (Arrow batches, NumPy matmul) and
the results are joined onto the examples, instead of running the MLP once per
example row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duotower.functions.hashing import init_matrix, init_vector_col
from duotower.functions.vectors import dot, round_half_even, sigmoid
from duotower.operators.lookup import embedding_lookup, embedding_lookups

TOWERS = ("query", "candidate")


# ------------------------------------------------------------------ parameters

def init_table(spark: SparkSession, name: str, num_embeddings: int, dim: int, seed: int = 42) -> DataFrame:
    """M1: table ``name`` with rows Uniform(-sqrt(1/n), sqrt(1/n)) derived from md5(seed|name|row|col).

    Same values for any partitioning; built by the executors from ``range``.
    """
    bound = math.sqrt(1.0 / num_embeddings)
    return (spark.range(num_embeddings).select(
        F.col("id").alias("bucket"),
        init_vector_col(seed, name, F.col("id"), dim, bound).alias("vec"),
        F.lit(0.0).alias("g2")))


def init_mlp(seed: int, name: str, in_dim: int, layer_sizes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linear-layer default init: W, b ~ Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)); W is (out, in)."""
    layers, fan_in = [], in_dim
    for k, out in enumerate(layer_sizes):
        bound = 1.0 / math.sqrt(fan_in)
        w = init_matrix(seed, f"{name}.{k}.weight", out, fan_in, bound)
        b = init_matrix(seed, f"{name}.{k}.bias", 1, out, bound)[0]
        layers.append((w, b))
        fan_in = out
    return layers


@dataclass
class DenseParams:
    """The two MLPs, plus Adam moments when training."""

    query: list
    candidate: list
    final_activation: str = "identity"

    @classmethod
    def init(cls, seed: int, dim: int, layer_sizes, final_activation: str = "identity") -> DenseParams:
        return cls(init_mlp(seed, "query_proj", dim, layer_sizes), init_mlp(seed, "candidate_proj", dim, layer_sizes),
                   final_activation)

    def tower(self, name: str) -> list:
        return self.query if name == "query" else self.candidate

    def flat(self) -> np.ndarray:
        return np.concatenate([np.concatenate([w.ravel(), b]) for t in TOWERS for (w, b) in self.tower(t)])

    def with_flat(self, v: np.ndarray) -> DenseParams:
        out, pos = {}, 0
        for t in TOWERS:
            layers = []
            for w, b in self.tower(t):
                nw, nb = w.size, b.size
                layers.append((v[pos:pos + nw].reshape(w.shape).copy(), v[pos + nw:pos + nw + nb].copy()))
                pos += nw + nb
            out[t] = layers
        return DenseParams(out["query"], out["candidate"], self.final_activation)

    def to_rows(self) -> list[tuple]:
        """(tower, layer, row, weights, bias) rows for saving."""
        rows = []
        for t in TOWERS:
            for k, (w, b) in enumerate(self.tower(t)):
                for r in range(w.shape[0]):
                    rows.append((t, k, r, [float(x) for x in w[r]], float(b[r])))
        return rows

    @classmethod
    def from_rows(cls, rows, final_activation: str = "identity") -> DenseParams:
        by = {}
        for t, k, r, w, b in rows:
            by.setdefault(t, {}).setdefault(k, {})[r] = (w, b)
        towers = {}
        for t in TOWERS:
            layers = []
            for k in sorted(by[t]):
                rr = by[t][k]
                idx = sorted(rr)
                layers.append((np.array([rr[r][0] for r in idx], dtype=np.float64),
                               np.array([rr[r][1] for r in idx], dtype=np.float64)))
            towers[t] = layers
        return cls(towers["query"], towers["candidate"], final_activation)


DENSE_SCHEMA = "tower string, layer int, row int, weights array<double>, bias double"


# ------------------------------------------------------------------ forward

def mlp_np(x: np.ndarray, layers, final_activation: str = "identity") -> np.ndarray:
    """NumPy tower forward: ReLU between layers, ``final_activation`` after the last one."""
    h = x
    for k, (w, b) in enumerate(layers):
        h = h @ w.T + b
        if k < len(layers) - 1 or final_activation == "relu":
            h = np.maximum(h, 0.0)
    return h


def _arrow_matrix(col: pa.Array, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(col), dim)


def _arrow_lists(m: np.ndarray) -> pa.Array:
    n, d = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), type=pa.float64()))


def tower_forward(df: DataFrame, vec_col: str, layers, out: str, in_dim: int,
                  final_activation: str = "identity") -> DataFrame:
    """F6 / M2 (Arrow path): add ``out`` = MLP(``vec_col``) for every row.

    Runs as ``mapInArrow``: each Arrow batch becomes one (rows x in_dim) matrix
    and one matmul per layer. The weights (fixed size, from the config) are a
    broadcast variable. ``vec_col`` must be non-null with ``in_dim`` entries.
    """
    bc = df.sparkSession.sparkContext.broadcast(
        [(np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64)) for w, b in layers])
    fields = [f for f in df.schema.fields]
    out_schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.DoubleType()), False)])

    def run(batches):
        weights = bc.value
        for batch in batches:
            x = _arrow_matrix(batch.column(vec_col), in_dim)
            y = mlp_np(x, weights, final_activation)
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [_arrow_lists(y)],
                                             names=list(batch.schema.names) + [out])

    return df.mapInArrow(run, out_schema)


def tower_table(table: DataFrame, layers, out: str, in_dim: int, final_activation: str = "identity",
                key: str = "bucket", vec: str = "vec") -> DataFrame:
    """R2: tower output for every table row, ``(bucket, out)``."""
    t = table.select(key, F.transform(F.col(vec), lambda x: x.cast("double")).alias(vec))
    return tower_forward(t, vec, layers, out, in_dim, final_activation).select(key, out)


def referenced_rows(table: DataFrame, df: DataFrame, bucket_col: str) -> DataFrame:
    """Table rows that ``df`` references (left-semi join on its distinct buckets).

    Worth it when ``df`` is small next to the table (a few evaluation batches);
    on a whole split most rows are referenced and the extra pass is wasted.
    """
    used = df.select(F.col(bucket_col).alias("bucket")).where(F.col("bucket").isNotNull()).distinct()
    return table.join(used, "bucket", "left_semi")


def attach_tower_outputs(df: DataFrame, bucket_col: str, table: DataFrame, layers, out: str, in_dim: int,
                         final_activation: str = "identity") -> DataFrame:
    """Per example: tower(table[bucket]) or, for a missing id, tower(zeros) (one vector, computed locally)."""
    outs = tower_table(table, layers, out, in_dim, final_activation)
    missing = mlp_np(np.zeros((1, in_dim)), layers, final_activation)[0]
    joined = embedding_lookup(df, bucket_col, outs.withColumnRenamed(out, "_tv"), out, len(missing),
                              table_vec="_tv")
    miss = F.array(*[F.lit(float(v)) for v in missing])
    return joined.withColumn(out, F.when(F.col(bucket_col).isNull(), miss).otherwise(F.col(out)))


def score_columns(df: DataFrame, q: str = "q", c: str = "c") -> DataFrame:
    """logit = q·c, prob = sigmoid(logit), pred = round-half-even(prob)."""
    return (df.withColumn("logit", dot(q, c))
            .withColumn("prob", sigmoid(F.col("logit")))
            .withColumn("pred", round_half_even(F.col("prob"))))


def score_pairs(examples: DataFrame, user_table: DataFrame, item_table: DataFrame, dense: DenseParams, dim: int,
                user_bucket: str = "user_bucket", item_bucket: str = "item_bucket") -> DataFrame:
    """M2 + M3 + R0 over an examples frame that already has bucket columns."""
    act = dense.final_activation
    sides = [(user_bucket, user_table, dense.query, "q"), (item_bucket, item_table, dense.candidate, "c")]
    outs = [(col, tower_table(table, layers, out, dim, act).withColumnRenamed(out, "vec"), out) for col, table, layers, out in sides]
    # both lookups at once: no row carries the first tower's output through the shuffle of the second
    x = embedding_lookups(examples, outs, dense.query[-1][1].size, [table.count() for _, table, *_ in sides])
    for col, _, layers, out in sides:
        miss = F.array(*[F.lit(float(v)) for v in mlp_np(np.zeros((1, dim)), layers, act)[0]])
        x = x.withColumn(out, F.when(F.col(col).isNull(), miss).otherwise(F.col(out)))
    return score_columns(x).drop("q", "c")
