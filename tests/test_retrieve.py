"""Lookup, pooling and exact top-K against brute force."""

import re

import numpy as np
from pyspark.sql import functions as F

from duotower.functions.vectors import checksum
from duotower.operators.lookup import bag_pooling, embedding_lookup, embedding_lookups
from duotower.operators.retrieve import topk_exact


def _table(spark, mat):
    return spark.createDataFrame([(i, [float(v) for v in mat[i]]) for i in range(len(mat))],
                                 "bucket long, vec array<double>")


def test_topk_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(11)
    q = np.round(rng.normal(size=(37, 6)), 1)
    it = np.round(rng.normal(size=(53, 6)), 1)
    it[10] = it[20]          # duplicate item vectors -> exact ties, broken by id
    qs, items = _table(spark, q), _table(spark, it)
    want = {}
    s = q @ it.T
    for r in range(len(q)):
        order = sorted(range(len(it)), key=lambda j: (-s[r, j], j))[:5]
        want[r] = order
    for budget in (1 << 30, 600):   # one chunk, then many chunks (merge path)
        got = {}
        for row in topk_exact(qs, items, 5, 6, q_id="bucket", i_id="bucket", budget_bytes=budget).collect():
            got.setdefault(row.qid, {})[row["rank"]] = row.iid
        assert {k: [v[i] for i in range(1, 6)] for k, v in got.items()} == want


def test_lookup_missing_and_pooling(spark):
    mat = np.arange(12, dtype=float).reshape(4, 3)
    t = _table(spark, mat)
    ex = spark.createDataFrame([(1, 2), (2, None), (3, 0)], "k long, b long")
    out = {r.k: r.v for r in embedding_lookup(ex, "b", t, "v", 3).collect()}
    assert out == {1: [6.0, 7.0, 8.0], 2: [0.0, 0.0, 0.0], 3: [0.0, 1.0, 2.0]}
    # bags in long form: bag 1 = {1, 2, 2}, bag 2 = {0 (missing), 5 -> pmod 1}, bag 3 = {0}
    bags = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 0), (2, 5), (3, 0)], "bag long, id long")
    got = {r.bag: (r.bag_size, r.pooled) for r in bag_pooling(bags, ["bag"], "id", t, 4, 3).collect()}
    assert got[1] == (3, list(mat[1] + 2 * mat[2]))
    assert got[2] == (1, list(mat[1]))
    assert got[3] == (0, [0.0, 0.0, 0.0])


def test_hot_bag_pools_without_giant_group(spark):
    mat = np.eye(3)
    t = _table(spark, mat)
    bags = spark.range(30000).select(F.lit(1).alias("bag"), (F.col("id") % 3).alias("id"))
    r = bag_pooling(bags, ["bag"], "id", t, 3, 3, zero_is_missing=False).first()
    assert r.bag_size == 30000 and r.pooled == [10000.0, 10000.0, 10000.0]
    assert spark.createDataFrame([([1.0, 2.0],)], "v array<double>").select(checksum("v")).first()[0] == 5.0


def test_ivf_topk_exact_when_probing_all_lists_and_good_recall(spark):
    from duotower.operators.retrieve import topk_ivf

    rng = np.random.default_rng(21)
    centers = rng.normal(size=(8, 6)) * 4
    it = centers[rng.integers(0, 8, 400)] + rng.normal(size=(400, 6))
    q = rng.normal(size=(60, 6)) * 2
    qs, items = _table(spark, q), _table(spark, it)
    exact = {(r.qid, r.iid) for r in topk_exact(qs, items, 5, 6, q_id="bucket", i_id="bucket").collect()}
    full = {(r.qid, r.iid) for r in topk_ivf(qs, items, 5, 6, n_lists=8, n_probe=8, q_id="bucket",
                                             i_id="bucket", budget_bytes=2000).collect()}
    assert full == exact
    some = {(r.qid, r.iid) for r in topk_ivf(qs, items, 5, 6, n_lists=8, n_probe=3, q_id="bucket",
                                             i_id="bucket").collect()}
    assert len(some & exact) / len(exact) > 0.8


def test_topk_with_fewer_items_than_k(spark):
    q = _table(spark, np.eye(3))
    it = _table(spark, np.array([[1.0, 0, 0], [0, 2.0, 0]]))
    got = sorted((r.qid, r["rank"], r.iid) for r in topk_exact(q, it, 5, 3, q_id="bucket", i_id="bucket").collect())
    assert len(got) == 6 and (0, 1, 0) in got and (1, 1, 1) in got


def test_blocked_topk_many_blocks_matches_brute_force(spark):
    """Regression: group keys of both cogroup sides must have one type, or blocks silently miss their items."""
    rng = np.random.default_rng(31)
    q = rng.normal(size=(300, 4))
    it = rng.normal(size=(250, 4))
    got = topk_exact(_table(spark, q), _table(spark, it), 3, 4, q_id="bucket", i_id="bucket", budget_bytes=400)
    rows = {(r.qid, r["rank"], r.iid) for r in got.collect()}
    s = q @ it.T
    want = {(i, k + 1, int(j)) for i in range(300) for k, j in enumerate(sorted(range(250), key=lambda j: (-s[i, j], j))[:3])}
    assert rows == want


def test_best_takes_ties_in_column_order_and_tiles_agree():
    from duotower.operators.retrieve import _best, _scored_topk

    rng = np.random.default_rng(31)
    s = np.round(rng.normal(size=(40, 60)), 1)
    for k in (1, 7, 60, 80):
        want = [sorted(range(60), key=lambda j: (-s[r, j], j))[:k] for r in range(40)]
        assert _best(s, k).tolist() == want
    q, it = rng.integers(-2, 3, (9, 4)).astype(float), rng.integers(-2, 3, (300, 4)).astype(float)
    ids = rng.permutation(1000)[:300]
    whole = _scored_topk(np.arange(9), q, ids, it, 20, 4, item_tile=1000)
    tiled = _scored_topk(np.arange(9), q, ids, it, 20, 4, item_tile=7)
    sc = q @ it.T
    want = [ids[j] for r in range(9) for j in sorted(range(300), key=lambda j: (-sc[r, j], ids[j]))[:20]]
    assert whole[2].tolist() == tiled[2].tolist() == want


def test_tile_memory_is_bounded():
    import tracemalloc

    from duotower.operators.retrieve import _scored_topk

    rng = np.random.default_rng(32)
    q, it = rng.normal(size=(512, 16)), rng.normal(size=(100_000, 16))
    tracemalloc.start()
    _scored_topk(np.arange(512), q, np.arange(100_000), it, 10, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20, peak


def test_recommend_lists_movies_of_a_shared_row_and_missing_ids(spark):
    from duotower.config import TrainArgs
    from duotower.operators.retrieve import recommend
    from duotower.operators.towers import mlp_np
    from duotower.plans.train import init_state

    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 3), n_blocks=1)
    state = init_state(spark, args, [5, 3])
    users = spark.createDataFrame([(0,), (1,), (1,), (4,), (None,)], "userId long")
    movies = spark.createDataFrame([(m,) for m in (0, 1, 2, 4, 7, None)], "movieId long")     # 1, 4 and 7 share a row
    ut = {r.bucket: np.array(r.vec) for r in state.user_table.collect()}
    it = {r.bucket: np.array(r.vec) for r in state.item_table.collect()}
    zero = np.zeros(4)
    u = {x: mlp_np((ut[x] if x else zero)[None], state.dense.query)[0] for x in (0, 1, 4)}
    c = {x: mlp_np((it[x % 3] if x else zero)[None], state.dense.candidate)[0] for x in (0, 1, 2, 4, 7)}
    got = {}
    for r in recommend(users, movies, state, 4).collect():
        got.setdefault(r.userId, []).append((r["rank"], r.movieId))
    want = {x: list(enumerate(sorted(c, key=lambda m: (-round(float(u[x] @ c[m]), 12), m))[:4], 1)) for x in u}
    assert {x: sorted(v) for x, v in got.items()} == want


def test_two_lookups_in_cells(spark):
    """Both lookups at once, by broadcast, in cells (some cut) and by joins, equal one after the other: nulls, misses, repeated keys."""
    table = spark.createDataFrame([(b, None if b == 5 else [float(b), None if b == 6 else b / 3]) for b in [*range(30), 4, 4]] + [(None, [9.0, 9.0])],
                                  "bucket long, vec array<float>")
    rows = [(k, None if k % 11 == 0 else (3 if k % 2 else k % 35), k % 33, f"t{k % 3}") for k in range(400)]
    df = spark.createDataFrame(rows + rows[:20], "k long, a long, b long, s string")
    one = embedding_lookup(embedding_lookup(df, "a", table, "u", 2), "b", table, "i", 2)
    want = sorted(map(repr, one.collect()))
    for kw in ({}, {"small_bytes": 0}, {"small_bytes": 0, "block_bytes": 200, "cell_rows": 30}, {"small_bytes": 0, "block_bytes": 30}):
        got = embedding_lookups(df, [("a", table, "u"), ("b", table, "i")], 2, **kw)
        assert got.columns == one.columns
        assert sorted(map(repr, got.collect())) == want, kw


def test_lookups_do_not_shuffle_vectors_with_rows(spark):
    """Spark's own estimate would broadcast a table of any width, and the second join would carry the first vector along."""
    wide = spark.range(2000).select(F.col("id").alias("bucket"), F.array_repeat(F.lit(1.0), 64).alias("vec"))
    df = spark.range(20_000).select((F.col("id") % 2000).alias("a"), (F.col("id") % 1999).alias("b"))
    one = embedding_lookup(df, "a", wide, "u", 64)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in one
    cells = embedding_lookups(df, [("a", wide, "u"), ("b", wide, "i")], 64, small_bytes=0)
    assert "MapInArrow" in cells._jdf.queryExecution().optimizedPlan().toString()
    assert cells.where((F.size("u") == 64) & (F.size("i") == 64)).count() == 20_000


def test_cells_read_their_blocks_and_shuffle_no_vectors(spark):
    """Copies of the vectors in the shuffle grow with the cells times the table; float vectors, a null one and empty blocks are read back."""
    table = spark.range(2000).select(F.col("id").alias("bucket"), F.when(F.col("id") != 7, F.array(F.col("id"), F.lit(0.5)).cast("array<float>")).alias("vec"))
    df = spark.range(20_000).select((F.col("id") % 2100).alias("a"), (F.col("id") % 1999).alias("b"))
    for block_bytes in (10_000, 1 << 20):
        cells = embedding_lookups(df, [("a", table, "u"), ("b", table, "i")], 2, small_bytes=0, block_bytes=block_bytes)
        plan = cells._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "_vec" not in plan and "Union" not in plan
        one = embedding_lookup(embedding_lookup(df, "a", table, "u", 2), "b", table, "i", 2)
        assert sorted(map(repr, cells.collect())) == sorted(map(repr, one.collect()))


def test_bags_pooled_in_cells(spark):
    """Pooling in cells (hot bags by joins) equals pooling by a join: null keys and ids, misses, repeated and null vectors."""
    table = spark.createDataFrame([(b, None if b == 5 else [float(b), None if b == 6 else b / 2]) for b in [*range(30), 4]]
                                  + [(None, [9.0, 9.0])], "bucket long, vec array<float>")
    rows = [(None if k % 50 == 0 else (7 if k % 3 == 0 else k // 4), f"s{k % 2}", None if k % 11 == 0 else k % 40) for k in range(3000)]
    bags = spark.createDataFrame(rows, "bag long, s string, id long")
    want = sorted(map(repr, bag_pooling(bags, ["bag", "s"], "id", table, 35, 2).collect()))
    for cell_rows in (40, 100_000):
        cells = bag_pooling(bags, ["bag", "s"], "id", table, 35, 2, small_bytes=0, cell_rows=cell_rows)
        assert "MapInArrow" in cells._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(repr, cells.collect())) == want


def test_small_blocks_do_not_copy_every_row_to_every_block(spark):
    """A small budget cuts what is scored at a time; it must not set how often rows are shuffled."""
    t = _table(spark, np.random.default_rng(5).normal(size=(600, 4)))
    plan = topk_exact(t, t, 3, 4, q_id="bucket", i_id="bucket", budget_bytes=80)._jdf.queryExecution().analyzed().toString()
    chunks = [int(n) for n in re.findall(r"explode\(sequence\(0, (\d+)", plan)]
    assert chunks and max(chunks) < 16
