"""The SQL scorer, the mergeable AUROC state, and the head by threshold."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duotower.config import TrainArgs
from duotower.operators.metrics import AUROC_ERROR, auroc, auroc_of_state, auroc_state, merge_auroc_states
from duotower.operators.scorer import register_saved_scorer, register_scorer
from duotower.operators.sort import head_candidates, sorted_head
from duotower.operators.towers import score_pairs
from duotower.plans.train import init_state, with_buckets
from duotower.sources.model_store import save_model

PAIRS = "userId long, movieId long, label int"


@pytest.mark.parametrize("zero_is_missing", [True, False])
def test_sql_scores_equal_the_join(spark, tmp_path, zero_is_missing):
    args = TrainArgs(embedding_dim=6, layer_sizes=(5, 3), seed=2, zero_is_missing=zero_is_missing)
    state = init_state(spark, args, [7, 9])
    save_model(state, str(tmp_path), 0)
    register_saved_scorer(spark, str(tmp_path), 0, "rate")
    rows = [(u, i, 1) for u in (None, 0, 1, 6, 7, 40) for i in (None, 0, 3, 8, 11)]
    df = spark.createDataFrame(rows, PAIRS)
    df.createOrReplaceTempView("pairs_to_score")
    got = {(r.userId, r.movieId): (r.l, r.p) for r in spark.sql("SELECT userId, movieId, rate(userId, movieId) AS l, rate_prob(userId, movieId) AS p FROM pairs_to_score").collect()}
    want = score_pairs(with_buckets(df, [7, 9], zero_is_missing), state.user_table, state.item_table, state.dense, 6).collect()
    assert len(got) == len(want) == len(rows)
    for r in want:
        assert np.allclose(got[r.userId, r.movieId], (r.logit, r.prob), atol=1e-12)
    with pytest.raises(ValueError):
        register_scorer(spark, state, "no name")


def test_scores_by_blocks_carry_no_vectors(spark):
    """Tables of many blocks, rows dealt or not, held by few or all: the scores of the join, without a join or a vector in the plan."""
    args = TrainArgs(embedding_dim=6, layer_sizes=(5, 3), seed=2)
    state = init_state(spark, args, [37, 53])
    rows = [(None if k % 11 == 0 else k * 7 % 90, None if k % 13 == 0 else k * k % 60, 1) for k in range(400)] * 2
    df = spark.createDataFrame(rows, PAIRS).repartition(3)
    want = sorted((str((r.userId, r.movieId)), r.logit, r.prob) for r in
                  score_pairs(with_buckets(df, [37, 53]), state.user_table, state.item_table, state.dense, 6).collect())
    for held, dealt in ((10, False), (10**6, False), (10, True)):
        scorer = register_scorer(spark, state, "blockwise", block_bytes=10 * 32, held_rows=held)
        assert min(scorer.blocks) > 3
        (scorer.deal(df, cell_rows=20) if dealt else df).createOrReplaceTempView("block_pairs")
        out = spark.sql("SELECT userId, movieId, label, blockwise(userId, movieId) AS l, blockwise_prob(userId, movieId) AS p FROM block_pairs")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "array<" not in plan and "blockwise_users" not in plan and plan.count("Join") == (1 if dealt else 0)     # the deal joins its cells
        got = sorted((str((r.userId, r.movieId)), r.l, r.p) for r in out.collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1:] for g in got], [w[1:] for w in want], atol=1e-12)
    empty = scorer.deal(df.where("userId > 1000"))
    assert empty.columns == df.columns and empty.count() == 0


def test_auroc_of_merged_sketches(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g, (shift, digits) in {"apart": (1.0, 6), "ties": (0.4, 1), "same": (0.0, 3)}.items():
        y = rng.integers(0, 2, 12000)
        rows += [(g, int(a), float(np.round(b, digits)), k % 5) for k, (a, b) in enumerate(zip(y, rng.normal(size=12000) + shift * y))]
    rows += [("one class", 1, 0.5, 0), ("none", None, 0.5, 0), ("all equal", 1, 2.0, 0), ("all equal", 0, 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, label int, logit double, batch int")
    states = auroc_state(df, ["g", "batch"])
    got = {r.g: r.auroc for r in auroc_of_state(merge_auroc_states(states, ["g"]), ["g"]).collect()}
    exact = {r.g: r.auroc for r in auroc(df, ["g"]).collect()}
    assert set(got) == {"apart", "ties", "same", "one class", "all equal"} and got["one class"] is None and got["all equal"] == 0.5
    for g in ("apart", "ties", "same"):
        assert abs(got[g] - exact[g]) <= AUROC_ERROR < 0.0036
    assert states.agg(F.max(F.octet_length("pos"))).first()[0] < 200_000


@pytest.mark.parametrize("kind", ["spread", "hot", "nulls"])
def test_head_by_threshold_is_the_sorted_head(spark, kind):
    rnd = random.Random(3)
    key = {"spread": lambda k: f"u{rnd.randrange(10**6):06}", "hot": lambda k: "u0" if k % 3 == 0 else f"u{rnd.randrange(500)}",
           "nulls": lambda k: None if k % 50 == 0 else f"u{rnd.randrange(3000)}"}[kind]
    rows = [(key(k), k % 400 if k % 7 else None, k % 2) for k in range(6000)]
    df = spark.createDataFrame(rows, "userId string, movieId long, label int").repartition(4)
    order = sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
    for n in (1, 37, 300):
        some = head_candidates(df, n, ["userId", "movieId"], sample_rows=1000)
        assert n <= some.count() < 6000
        assert sorted(map(repr, map(tuple, sorted_head(some, n, ["userId", "movieId"], 4).collect()))) == sorted(map(repr, order[:n]))
    assert head_candidates(df, 4000, ["userId"], sample_rows=1000).count() == 6000
