"""Model math and training: gradients, towers, init rule, one-block round = NumPy loop, save/load, learning."""

import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from duotower.config import TrainArgs
from duotower.functions.gradients import Adam, flatten_grads, rowwise_adagrad, two_tower_step
from duotower.functions.hashing import init_matrix
from duotower.functions.vectors import dense_layer
from duotower.operators.towers import DenseParams, init_table, mlp_np, tower_forward
from duotower.plans.train import block_examples, evaluate, init_state, run_round, touched_rows
from duotower.sources.model_store import load_model, save_model

EX = "userId long, movieId long, label int, row_id long"


@pytest.mark.parametrize("final_relu", [False, True])
def test_finite_difference_gradients(final_relu):
    rng = np.random.default_rng(3)
    q = DenseParams.init(1, 4, [4, 2], "relu" if final_relu else "identity")
    eu, ei = rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    y = np.array([0, 1, 1, 0, 1, 0], dtype=float)

    def loss(theta, a, b):
        d = q.with_flat(theta)
        return two_tower_step(a, b, y, d.query, d.candidate, final_relu)[0].mean()

    th = q.flat()
    _, gq, gc, deu, dei = two_tower_step(eu, ei, y, q.query, q.candidate, final_relu)
    g = flatten_grads(gq, gc)
    h = 1e-6
    for k in rng.choice(th.size, 12, replace=False):
        e = np.zeros_like(th)
        e[k] = h
        assert (loss(th + e, eu, ei) - loss(th - e, eu, ei)) / (2 * h) == pytest.approx(g[k], abs=1e-6)
    for r, c in [(0, 1), (3, 2)]:
        e = np.zeros_like(eu)
        e[r, c] = h
        assert (loss(th, eu + e, ei) - loss(th, eu - e, ei)) / (2 * h) == pytest.approx(deu[r, c], abs=1e-6)
        assert (loss(th, eu, ei + e) - loss(th, eu, ei - e)) / (2 * h) == pytest.approx(dei[r, c], abs=1e-6)


def test_towers_native_arrow_numpy_agree(spark):
    layers = DenseParams.init(7, 5, [4, 3]).query
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(40)], "id long, vec array<double>")
    want = mlp_np(x, layers, "identity")
    arrow = {r.id: r.out for r in tower_forward(df, "vec", layers, "out", 5).collect()}
    h = dense_layer(F.col("vec"), layers[0][0].tolist(), layers[0][1].tolist(), "relu")
    native = {r.id: r.h for r in df.select("id", dense_layer(h, layers[1][0].tolist(), layers[1][1].tolist(),
                                                             "identity").alias("h")).collect()}
    for i in range(40):
        assert np.allclose(arrow[i], want[i], atol=1e-12) and np.allclose(native[i], want[i], atol=1e-12)


def test_init_rule_same_in_spark_and_python(spark):
    rows = {r.bucket: r.vec for r in init_table(spark, "t_x", 6, 3, seed=5).collect()}
    want = init_matrix(5, "t_x", 6, 3, math.sqrt(1 / 6))
    for b in range(6):
        assert np.allclose(rows[b], want[b], atol=0)


def _tiny_examples(spark):
    rows, rid = [], 0
    rng = np.random.default_rng(5)
    for _ in range(23):
        rows.append((int(rng.integers(0, 5)), int(rng.integers(0, 6)), int(rng.integers(0, 2)), rid * 7919 + 11))
        rid += 1
    return spark.createDataFrame(rows, EX), rows


@pytest.mark.parametrize("arrow_batch", [10000, 5])
def test_one_block_round_equals_numpy_loop(spark, arrow_batch):
    """With one block the streamed round is plain sequential training, also when Arrow batches cut mini-batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_batch))
    try:
        _one_block_round(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _one_block_round(spark):
    args = TrainArgs(epochs=1, embedding_dim=4, layer_sizes=(4, 2), learning_rate=0.02, batch_size=4, n_blocks=1,
                     table_learning_rate=0.1, seed=9)
    counts = [5, 6]
    df, rows = _tiny_examples(spark)
    state = init_state(spark, args, counts)
    blocked = block_examples(df, args, counts, 1)
    keys = touched_rows(blocked)
    out = os.path.join(tempfile.mkdtemp(prefix="dt-round-"), "step=0")
    res = run_round(state, blocked, keys, 0, 1, out, None, order_seed=123)

    # the same computation, sequentially in NumPy
    U = init_matrix(9, "t_userId", 5, 4, math.sqrt(1 / 5))
    I = init_matrix(9, "t_movieId", 6, 4, math.sqrt(1 / 6))
    gu, gi = np.zeros(5), np.zeros(6)
    dense = DenseParams.init(9, 4, (4, 2))
    rid = np.array([r[3] for r in rows], dtype=np.int64)
    # the round streams each block in (xxhash64(row_id, seed), row_id) order
    h = {r.row_id: r.h for r in df.select("row_id", F.xxhash64("row_id", F.lit(123)).alias("h")).collect()}
    idx = np.lexsort((rid, np.array([h[x] for x in rid])))
    ub = np.array([r[0] if r[0] != 0 else -1 for r in rows])[idx]
    ib = np.array([r[1] if r[1] != 0 else -1 for r in rows])[idx]
    y = np.array([r[2] for r in rows], dtype=float)[idx]
    Up, Ip = np.vstack([U, np.zeros((1, 4))]), np.vstack([I, np.zeros((1, 4))])
    opt, th = Adam(0.02), dense.flat()
    for s in range(0, len(y), 4):
        sl = slice(s, s + 4)
        eu, ei = Up[np.where(ub[sl] >= 0, ub[sl], 5)], Ip[np.where(ib[sl] >= 0, ib[sl], 6)]
        d = dense.with_flat(th)
        _, gq, gc, deu, dei = two_tower_step(eu, ei, y[sl], d.query, d.candidate, False)
        rowwise_adagrad(Up, gu, ub[sl], deu, 0.1, 1e-8)
        rowwise_adagrad(Ip, gi, ib[sl], dei, 0.1, 1e-8)
        th = opt.step(th, flatten_grads(gq, gc))

    got_u = {r.bucket: r.vec for r in res.state.user_table.collect()}
    got_i = {r.bucket: r.vec for r in res.state.item_table.collect()}
    assert np.allclose(np.array([got_u[b] for b in range(5)]), Up[:5], atol=1e-12)
    assert np.allclose(np.array([got_i[b] for b in range(6)]), Ip[:6], atol=1e-12)
    assert np.allclose(res.state.dense.flat(), th, atol=1e-12)
    assert res.state.adam_t == opt.t and np.allclose(res.state.adam_m, opt.m, atol=1e-12)


def test_save_load_same_scores(spark):
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=8, n_blocks=2)
    df, _ = _tiny_examples(spark)
    state = init_state(spark, args, [5, 6])
    root = tempfile.mkdtemp(prefix="dt-save-")
    save_model(state, root, 3)
    back = load_model(spark, root, "latest")
    a = evaluate(state, df, "x")
    b = evaluate(back, df, "x")
    assert back.step == 3 and a == b


def test_hot_user_is_spread_over_blocks(spark):
    rows = [(7, i % 50, i % 2, i) for i in range(3000)] + [(u, 1, 0, 10_000 + u) for u in range(1, 40)]
    df = spark.createDataFrame(rows, EX)
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), n_blocks=8, hot_user_rows=500)
    b = block_examples(df, args, [100, 100], 8)
    sizes = [r["count"] for r in b.where(F.col("user_bucket") == 7).groupBy("block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3000 / 4
    # users under the threshold stay whole in one block
    assert b.where(F.col("user_bucket") == 3).select("block").distinct().count() == 1


def test_training_learns_planted_signal(spark):
    rng = np.random.default_rng(7)
    pu, pi = rng.normal(size=(300, 3)), rng.normal(size=(200, 3))
    u, i = rng.integers(1, 301, 16000), rng.integers(1, 201, 16000)
    y = ((pu[u - 1] * pi[i - 1]).sum(1) > 0).astype(int)
    rows = [(int(a), int(b), int(c), k) for k, (a, b, c) in enumerate(zip(u, i, y))]
    df = spark.createDataFrame(rows, EX)
    split = F.pmod(F.xxhash64("row_id"), F.lit(5))
    train, test = df.where(split != 0), df.where(split == 0)
    args = TrainArgs(embedding_dim=16, layer_sizes=(16, 8), learning_rate=0.01, table_learning_rate=0.1,
                     batch_size=256, n_blocks=4)
    counts = [301, 201]
    state = init_state(spark, args, counts)
    blocked = block_examples(train, args, counts, 4).checkpoint()
    keys = touched_rows(blocked).checkpoint()
    root = tempfile.mkdtemp(prefix="dt-learn-")
    before = evaluate(state, test, "test")["auroc"]
    for epoch in range(8):
        state = run_round(state, blocked, keys, 0, 4, f"{root}/step={epoch}", None, order_seed=epoch).state
    after = evaluate(state, test, "test")["auroc"]
    assert after > 0.85 and after > before + 0.2, (before, after)


def test_train_loop_phases_and_relu_compat(spark):
    """M7 with validation_freq; the relu-final (library default) tower still trains without error."""
    from duotower.plans.train import train_val_test

    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 40)), int(rng.integers(0, 30)), int(rng.integers(0, 2)), k) for k in range(3000)]
    df = spark.createDataFrame(rows, EX)
    split = F.pmod(F.xxhash64("row_id"), F.lit(10))
    args = TrainArgs(epochs=2, embedding_dim=8, layer_sizes=(8, 4), batch_size=128, n_blocks=2,
                     rounds_per_epoch=2, validation_freq=1, final_activation="relu", limit_val_batches=3)
    root = tempfile.mkdtemp(prefix="dt-loop-")
    state, m = train_val_test(spark, df.where(split < 7), df.where(split >= 8), df.where(split == 7), args,
                              [40, 30], root, "run-x")
    phases = {(r.phase, r.step) for r in m.select("phase", "step").distinct().collect()}
    assert ("base", None) in phases and ("test", None) in phases
    assert {("epoch", 0), ("epoch", 1)} <= phases
    assert {("val_step", 1), ("val_step", 2), ("val_step", 3), ("val_step", 4)} <= phases
    assert {("train", 1), ("train", 4)} <= phases
    val_rows = [r.value for r in m.where("name = 'val_rows'").collect()]
    assert max(val_rows) <= 3 * 128
    assert load_model(spark, f"{root}/model", "latest").step == 1


def test_item_strata_give_disjoint_items_per_round(spark):
    rng = np.random.default_rng(12)
    rows = [(int(rng.integers(1, 60)), int(rng.integers(1, 80)), int(rng.integers(0, 2)), k) for k in range(4000)]
    df = spark.createDataFrame(rows, EX)
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=64, n_blocks=3, item_blocks=3)
    assert args.rounds == 3
    blocked = block_examples(df, args, [60, 80], 3).checkpoint()
    # every example lands in exactly one (block, round); per round, item sets of the blocks are disjoint
    assert blocked.count() == 4000
    per = blocked.where("item_bucket IS NOT NULL").groupBy("part", "item_bucket").agg(
        F.count_distinct("block").alias("nb"))
    assert per.agg(F.max("nb")).first()[0] == 1
    keys = touched_rows(blocked).checkpoint()
    state = init_state(spark, args, [60, 80])
    root = tempfile.mkdtemp(prefix="dt-strata-")
    res = run_round(state, blocked, keys, 1, 3, f"{root}/step=0", None, order_seed=5)
    out = spark.read.parquet(f"{root}/step=0/_round_output").where("kind = 'i'")
    assert out.groupBy("bucket").count().agg(F.max("count")).first()[0] == 1
    assert res.n_rows == blocked.where("part = 1").count()


def test_resume_continues_after_latest_epoch(spark):
    from duotower.plans.train import train_val_test

    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(1, 30)), int(rng.integers(1, 20)), int(rng.integers(0, 2)), k) for k in range(1500)]
    df = spark.createDataFrame(rows, EX)
    split = F.pmod(F.xxhash64("row_id"), F.lit(10))
    tr, va, te = df.where(split < 7), df.where(split >= 8), df.where(split == 7)
    root = tempfile.mkdtemp(prefix="dt-resume-")
    a1 = TrainArgs(epochs=1, embedding_dim=4, layer_sizes=(4, 2), batch_size=64, n_blocks=2)
    train_val_test(spark, tr, va, te, a1, [30, 20], root, "r")
    a2 = TrainArgs(epochs=2, embedding_dim=4, layer_sizes=(4, 2), batch_size=64, n_blocks=2)
    state, m = train_val_test(spark, tr, va, te, a2, [30, 20], root, "r", resume=True)
    epochs = sorted(r.step for r in m.where("phase = 'epoch'").select("step").distinct().collect())
    assert epochs == [0, 1] and m.where("phase = 'base'").select("name").distinct().count() == 4
    assert m.where("phase = 'train'").select("step").distinct().count() == 2   # rounds 1 and 2, no repeat


def test_evaluate_empty_split(spark):
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=8, n_blocks=2)
    state = init_state(spark, args, [5, 6])
    empty = spark.createDataFrame([], EX)
    r = evaluate(state, empty, "x")
    assert r["n_rows"] == 0 and r["auroc"] is None


def test_batch_limit_caps_rows_per_round(spark):
    rows = [(int(u), int(i), int((u + i) % 2), k) for k, (u, i) in enumerate(zip(range(2000), range(2000)))]
    df = spark.createDataFrame([(r[0] % 40 + 1, r[1] % 30 + 1, r[2], r[3]) for r in rows], EX)
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=50, n_blocks=2, limit_train_batches=6)
    blocked = block_examples(df, args, [41, 31], 2)
    keys = touched_rows(blocked)
    state = init_state(spark, args, [41, 31])
    res = run_round(state, blocked, keys, 0, 2, tempfile.mkdtemp(prefix="dt-lim-") + "/step=0", 6, order_seed=3)
    assert res.n_batches == 6 and res.n_rows == 300


def test_round_conserves_rows_with_several_blocks_per_task(spark):
    rng = np.random.default_rng(14)
    rows = [(int(rng.integers(0, 70)), int(rng.integers(0, 50)), int(rng.integers(0, 2)), k) for k in range(5000)]
    df = spark.createDataFrame(rows, EX)
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=64, n_blocks=7)   # 7 blocks, 4 shuffle partitions
    blocked = block_examples(df, args, [70, 50], 7).checkpoint()
    keys = touched_rows(blocked).checkpoint()
    root = tempfile.mkdtemp(prefix="dt-cons-")
    res = run_round(init_state(spark, args, [70, 50]), blocked, keys, 0, 7, f"{root}/step=0", None, order_seed=2)
    o = spark.read.parquet(f"{root}/step=0/_round_output")
    t = {r.kind: (r.c, r.t) for r in o.groupBy("kind").agg(F.count(F.lit(1)).alias("c"),
                                                           F.sum("touches").alias("t")).collect()}
    assert res.n_rows == 5000
    assert t["u"][1] == blocked.where("user_bucket IS NOT NULL").count()
    assert t["i"][1] == blocked.where("item_bucket IS NOT NULL").count()
    assert t["u"][0] == keys.where("kind = 'u'").count() and t["i"][0] == keys.where("kind = 'i'").count()
    assert t["d"][0] == 7      # one row of weights per block, whatever the number of tasks
