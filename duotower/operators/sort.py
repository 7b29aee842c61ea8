"""Sort + limit and first row (L1, L3)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.functions.ranking import global_row_index

SAMPLE_ROWS = 20_000        # keys that choose the cut of a head


def sorted_head(df: DataFrame, n: int, keys: list[str], n_partitions: int) -> DataFrame:
    """L1: first ``n`` rows ordered by ``keys`` and then by every other column.

    The extra tie-break makes the cut-off deterministic when key values repeat. The head is cut from a distributed
    global ranking, so no task holds more than its own range of the order, whatever ``n`` is. If ``n`` is well below the
    number of rows, only those up to a key found from a sample are ranked (``head_candidates``).
    """
    df = head_candidates(df, n, keys)
    order = [F.col(k).asc_nulls_first() for k in keys]
    order += [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    # Identical copies of a row share every sort key; a scan-order id as the last key lets the range
    # partitioner split a group of copies that holds a large share of the rows.
    tagged = df.withColumn("_scan_id", F.monotonically_increasing_id())
    ranked = global_row_index(tagged, order + [F.col("_scan_id")], n_partitions, out="_rank")
    return ranked.where(F.col("_rank") < n).drop("_rank", "_scan_id")


def head_candidates(df: DataFrame, n: int, keys: list[str], sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows that hold the first ``n`` by ``keys``, and a little more: those up to the key at a safe position of a sample.

    The sample (about ``sample_rows`` keys, a documented bound) only chooses the cut: if fewer than ``n`` rows lie below it, or
    half of all rows do, all rows are candidates. Rows with the key at the cut are all kept.
    """
    total = df.count()
    if total <= max(2 * n, sample_rows):
        return df
    share = sample_rows / total
    place = math.ceil(n * share + 4 * math.sqrt(n * share) + 1)
    if place >= sample_rows // 2:
        return df
    order = [F.col(k).asc_nulls_first() for k in keys]
    some = df.select(*keys).sample(share, seed=1).orderBy(*order).limit(place)
    row = some.agg(F.max(F.struct(*keys)).alias("cut")).first()
    if row["cut"] is None:
        return df
    cut = F.struct(*[F.lit(row["cut"][k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    head = df.where(F.struct(*keys) <= cut)
    return head if head.count() >= n else df


def first_row(df: DataFrame) -> DataFrame:
    """L3."""
    return df.limit(1)
