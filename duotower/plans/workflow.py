"""The reference's end-to-end run as plain functions over a shared folder.

    prepare_and_export:  ratings -> prepare -> one zstd Parquet folder per split (+ manifest)
    run_training:        exported splits -> train_val_test -> model steps + run tables
    score_saved_model:   saved step -> scores on the test split

Everything is written under one run folder in the shared scratch root
(``spark.checkpoint.dir``), so a retried or resumed job finds its inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.config import TrainArgs
from duotower.operators.profile import distinct_with_null
from duotower.plans.prepare import prepare
from duotower.plans.sync_train import train_val_test_sync
from duotower.plans.train import score_split, train_val_test
from duotower.session import default_parallelism, new_run_id, scratch_path
from duotower.snapshot import snapshot
from duotower.sources.export import export_splits, read_manifest, read_shards
from duotower.sources.model_store import load_model

SPLITS = ("train", "validation", "test")


@dataclass
class PreparedRun:
    root: str
    export_root: str
    emb_counts: list

    def split(self, spark: SparkSession, name: str) -> DataFrame:
        return read_shards(spark, f"{self.export_root}/split={name}")


def table_sizes(ratings: DataFrame) -> list:
    """Table sizes from the full ratings (null counts as a value), as the reference does."""
    r = distinct_with_null(ratings).first()
    return [int(r["user_count"]), int(r["movie_count"])]


def prepare_and_export(spark: SparkSession, ratings: DataFrame, run_id: str | None = None,
                       num_shards: int | None = None,
                       limit: int | None = None, materialize: bool = True) -> PreparedRun:
    """Prepare and export in one partitioned write (``num_shards=40`` for the reference's fixed sharding).

    ``materialize`` snapshots the projected ratings first: the mean, the user
    index and the main flow all read them, and the source may be an expensive
    join. Turn it off when the ratings are a plain table or already a snapshot.
    """
    root = scratch_path(spark, "runs", run_id or new_run_id())
    ratings = ratings.select("userId", "movieId", "rating")
    if materialize:
        ratings = snapshot(ratings, "ratings")
    ex = prepare(ratings, default_parallelism(spark), limit=limit)
    export_splits(ex, f"{root}/export", num_shards=num_shards)
    return PreparedRun(root, f"{root}/export", table_sizes(ratings))


def export_manifest(spark: SparkSession, run: PreparedRun) -> DataFrame:
    """The saved merged manifest of the export: (split, shard, rows, bytes)."""
    return read_manifest(spark, run.export_root)


def run_training(spark: SparkSession, run: PreparedRun, args: TrainArgs, run_id: str | None = None, sync: bool = False,
                 workers: int | None = None):
    """The training loop over an exported run: averaged blocks, or with ``sync`` one update per mini-batch over ``workers`` tasks."""
    rid = run_id or new_run_id()
    if sync:
        return train_val_test_sync(spark, run.split(spark, "train"), run.split(spark, "validation"), run.split(spark, "test"),
                                   args, run.emb_counts, run.root, rid, workers)
    return train_val_test(spark, run.split(spark, "train"), run.split(spark, "validation"), run.split(spark, "test"),
                          args, run.emb_counts, run.root, rid)


def sample_saved_predictions(spark: SparkSession, run: PreparedRun, step="latest", n: int = 5) -> DataFrame:
    """L4 + S9 + R0: the first ``n`` single-row batches of the test stream, scored by a saved step
    (label next to logit, probability and rounded prediction, as the reference prints them)."""
    from duotower.operators.retrieve import sample_rows
    from duotower.operators.towers import score_pairs
    from duotower.plans.train import with_buckets
    from duotower.streaming.batches import assign_batches

    state = load_model(spark, f"{run.root}/model", step)
    ex = with_buckets(run.split(spark, "test"), state.emb_counts, state.args.zero_is_missing)
    first = sample_rows(assign_batches(ex, ["row_id"], 1, 40, state.args.seed), n)
    scored = score_pairs(first, state.user_table, state.item_table, state.dense, state.args.embedding_dim)
    return scored.select("userId", "movieId", "label", "logit", "prob", "pred")


def score_saved_model(spark: SparkSession, run: PreparedRun, step="latest") -> DataFrame:
    """S9 + R0: reload a saved step and score the test split."""
    state = load_model(spark, f"{run.root}/model", step)
    return score_split(state, run.split(spark, "test"), "test").select("label", "logit", "prob", "pred")
