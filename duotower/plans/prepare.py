"""Prepare plan: ratings -> labelled, indexed, split examples (reference section 1).

    ratings -> [sorted head] -> label at mean -> split (hash of raw user, item)
            -> user index -> (userId long, movieId long, label int, split)

The label and the split do not depend on the index, so they come first: the
mean's scalar subquery then scans only the ratings, not the index join. The
split uses the raw ids, so it does not move when the index is recomputed on
more data. Nothing is collected: the mean is a scalar subquery and the index
is a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from duotower.operators.index import apply_index, fit_index
from duotower.operators.label import binarize_at_mean
from duotower.operators.sort import sorted_head
from duotower.operators.split import hash_split, random_split

EXAMPLE_COLS = ["userId", "movieId", "label"]


def index_users(ratings: DataFrame, n_partitions: int, user: str = "userId") -> DataFrame:
    """W1 + P2 + P3 on the user column."""
    return apply_index(ratings, fit_index(ratings, user, n_partitions), handle_invalid="error")


def labelled(ratings: DataFrame, n_partitions: int) -> DataFrame:
    """Binarise the rating, index users, keep (userId, movieId, label)."""
    return index_users(binarize_at_mean(ratings.select("userId", "movieId", "rating")), n_partitions)


def prepare(ratings: DataFrame, n_partitions: int, limit: int | None = None, weights=(0.7, 0.2, 0.1),
            split_method: str = "hash", seed: int = 42) -> DataFrame:
    """Full preparation. ``limit`` reproduces the reference's ``orderBy(user, movie).limit(n)``."""
    df = ratings.select("userId", "movieId", "rating")
    if limit is not None:
        df = sorted_head(df, limit, ["userId", "movieId"], n_partitions)
    df = binarize_at_mean(df)
    if split_method == "hash":
        df = hash_split(df, ["userId", "movieId"], weights)
    idx = fit_index(df, "userId", n_partitions)
    df = apply_index(df, idx, handle_invalid="error")
    df = df.select("userId", "movieId", "label", *(["split"] if split_method == "hash" else []))
    if split_method == "random":
        df = random_split(df, weights, seed)
    return df
