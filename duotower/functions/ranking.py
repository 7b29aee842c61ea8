"""Global order statistics without a single-partition window.

``global_row_index``: 0-based position of every row in a total order. Rows are
range-partitioned on the order, sorted within each partition, numbered by
``monotonically_increasing_id`` (partition id in the high bits, position in the
low 33 bits), checkpointed, and shifted by the row count of all earlier
partitions. The only un-partitioned step works on one row per partition.

``ordered_prefix_sum``: for a numeric column, the sum over all rows that come
strictly earlier in a total order. Rows are cut into contiguous ranges by
approximate quantiles of the order column; each range is summed with a
partitioned window and shifted by the totals of the earlier ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def global_row_index(df: DataFrame, order: list[Column], n_partitions: int, out: str = "index") -> DataFrame:
    """Add ``out`` = 0-based rank of each row under ``order`` (must be a total order).

    The numbered rows are checkpointed (to ``spark.checkpoint.dir``) before the
    partition sizes are taken from them: the range partitioner's bounds come
    from a sample, so two separate computations of the range shuffle could
    disagree. One snapshot serves both the sizes and the rows.
    """
    ranged = (df.repartitionByRange(n_partitions, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(_LOW33))
              .checkpoint())
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_sz"))
    # One row per range partition: bounded by n_partitions, so a global window and a broadcast are safe here.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_sz").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_loc"))
            .drop("_mid", "_pid", "_loc", "_off"))


def quantile_splits(df: DataFrame, col: str, n_buckets: int, rel_error: float | None = None) -> list[float]:
    """Strictly increasing split points (-inf, q_1, ..., q_k-1, +inf) from approximate quantiles.

    One small action: ``approxQuantile`` returns n_buckets - 1 numbers to the driver. The allowed rank error is a
    quarter of a bucket unless given, so more buckets really are smaller.
    """
    if rel_error is None:
        rel_error = 0.25 / max(1, n_buckets)
    qs = df.approxQuantile(col, [i / n_buckets for i in range(1, n_buckets)], rel_error) if n_buckets > 1 else []
    inner = sorted({float(q) for q in qs if q == q and abs(q) != float("inf")})
    return [float("-inf")] + inner + [float("inf")]


def quantile_bucket(df: DataFrame, col: str, n_buckets: int, out: str = "_bk") -> DataFrame:
    """Add ``out``: a monotone bucket number from approximate quantiles of ``col`` (binary search per row).

    Equal values always share a bucket; balance only depends on the quantiles.
    """
    from pyspark.ml.feature import Bucketizer

    splits = quantile_splits(df, col, n_buckets)
    if len(splits) < 3:          # one bucket (all values equal, or no rows)
        return df.withColumn(out, F.lit(0))
    src = df.withColumn("_qb_in", F.col(col).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_qb_in", outputCol="_qb_out", handleInvalid="keep")
    return b.transform(src).withColumn(out, F.col("_qb_out").cast("int")).drop("_qb_in", "_qb_out")


def ordered_prefix_sum(df: DataFrame, order_col: str, value_cols: list[str], n_buckets: int,
                       group_cols: list[str] | None = None, prefix: str = "before_") -> DataFrame:
    """Add ``before_<v>`` = sum of ``v`` over rows of the same group with a strictly smaller ``order_col``.

    ``order_col`` values must be distinct within a group (aggregate first).
    The offset table has groups x buckets rows; it is joined on the window's own partitioning, not broadcast.
    """
    groups = list(group_cols or [])
    b = quantile_bucket(df, order_col, n_buckets)
    w = Window.partitionBy(*groups, "_bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_in_{v}") for v in value_cols])
    totals = b.groupBy(*groups, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    earlier = Window.partitionBy(*groups).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}")
                                              for v in value_cols])
    out = inner.join(offsets, [*groups, "_bk"])
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.col(f"_in_{v}"))
    return out.drop("_bk", *[f"_in_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])
