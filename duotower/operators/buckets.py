"""Ids -> embedding-table rows.

The reference turns every id into ``id % num_embeddings`` unless the id is
"falsy" (``if value:``), so both NULL and 0 count as missing (SURVEY Q1).
Here a missing id is a NULL bucket (length-0 bag) and the modulo is ``pmod``,
which agrees with Python's ``%`` for negative ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_missing(c: Column, zero_is_missing: bool = True) -> Column:
    """P6."""
    return (c.isNull() | (c == 0)) if zero_is_missing else c.isNull()


def to_bucket(c: Column, num_embeddings, zero_is_missing: bool = True) -> Column:
    """P6 + P7: NULL for a missing id, else ``pmod(id, n)`` in [0, n)."""
    n = num_embeddings if isinstance(num_embeddings, Column) else F.lit(int(num_embeddings))
    return F.when(is_missing(c, zero_is_missing), F.lit(None)).otherwise(F.pmod(c.cast("long"), n.cast("long")))


def sparse_features(df: DataFrame, cat_cols: list[str], emb_counts: list, zero_is_missing: bool = True,
                    suffix: str = "_bucket") -> DataFrame:
    """One nullable bucket column per categorical feature; train and test share this code."""
    out = df
    for c, n in zip(cat_cols, emb_counts):
        out = out.withColumn(f"{c}{suffix}", to_bucket(F.col(c), n, zero_is_missing))
    return out


def bucket_collisions(df: DataFrame, col: str, num_embeddings, zero_is_missing: bool = True) -> DataFrame:
    """Table rows shared by more than one distinct id (the price of the hash trick)."""
    b = to_bucket(F.col(col), num_embeddings, zero_is_missing)
    return (df.select(F.col(col).alias("id"), b.alias("bucket")).where(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count_distinct("id").alias("n_ids"))
            .where(F.col("n_ids") > 1))
