"""Profiles and counts (A1-A5).

All counts of one frame are computed in a single aggregation pass instead of one
job per number as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_rating(c: Column) -> Column:
    """Rating usable for the mean and the label: not null and not NaN."""
    return F.when(c.isNull() | F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def profile_counts(df: DataFrame, user: str = "userId", item: str = "movieId", rating: str = "rating",
                   approx: bool = False) -> DataFrame:
    """A1 + A2 + A4: rows, distinct users/items (nulls ignored), mean rating, null/NaN counts.

    ``approx=True`` switches the distinct counts to HyperLogLog++ for very large inputs.
    """
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    r = F.col(rating)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct(F.col(user)).alias("n_users"),
        distinct(F.col(item)).alias("n_items"),
        F.avg(valid_rating(r)).alias("mean_rating"),
        F.sum(F.col(user).isNull().cast("long")).alias("n_null_user"),
        F.sum(F.col(item).isNull().cast("long")).alias("n_null_item"),
        F.sum(r.isNull().cast("long")).alias("n_null_rating"),
        F.sum(F.isnan(r).cast("long")).alias("n_nan_rating"),
    )


def distinct_count_with_null(c: Column) -> Column:
    """A3: distinct values counting NULL as one value (``select(c).distinct().count()``)."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("long")), F.lit(0))


def distinct_with_null(df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    return df.agg(distinct_count_with_null(F.col(user)).alias("user_count"),
                  distinct_count_with_null(F.col(item)).alias("movie_count"))


def split_summary(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """A5: rows and positive rate per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.avg(F.col(label).cast("double")).alias("pos_rate"))
