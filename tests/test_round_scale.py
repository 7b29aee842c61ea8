"""A training round at size: item rows are read by the blocks' tasks, not shuffled; a mini-batch costs its rows, not the table's."""

import tempfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from duotower.config import TrainArgs
from duotower.plans import train
from duotower.plans.train import KIND_ITEM, KIND_USER, _BlockState, block_examples, init_state, run_round, touched_rows
from duotower.sources.model_store import load_model, read_rows

ARGS = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=32, n_blocks=4)


def _blocked(spark, users, items, n=3000):
    rows = spark.range(n).select((F.col("id") * 7 % users).alias("userId"), (F.col("id") * 11 % items).alias("movieId"),
                                 (F.col("id") % 3 % 2).cast("int").alias("label"), F.col("id").alias("row_id"))
    return block_examples(rows, ARGS, [users, items], 4).checkpoint()


def test_item_rows_are_not_shuffled(spark, monkeypatch):
    seen = []
    whole = train.round_input

    def watched(ex, params, seed):
        seen.append(params)
        return whole(ex, params, seed)

    monkeypatch.setattr(train, "round_input", watched)
    blocked = _blocked(spark, 200, 30)
    keys = touched_rows(blocked).checkpoint()
    root = tempfile.mkdtemp(prefix="dt-scale-")
    results = {}
    for reads in (0, train.READS_PER_COPY):     # 0: every table row is joined to its keys and shuffled, as it was
        monkeypatch.setattr(train, "READS_PER_COPY", reads)
        state = init_state(spark, ARGS, [200, 30], f"{root}/{reads}")
        res = run_round(state, blocked, keys, 0, 4, f"{root}/{reads}/step=0", None, 3)
        results[reads] = [{r.bucket: (r.vec, r.g2) for r in t.collect()} for t in (res.state.user_table, res.state.item_table)]
    sizes = {r.kind: r.n for r in seen[-1].groupBy("kind").agg(F.max(F.size("vec")).alias("n")).collect()}
    assert sizes == {"u": 4, "i": 0}
    for a, b in zip(*results.values()):
        assert a.keys() == b.keys()
        assert all(a[k][0] == pytest.approx(b[k][0], abs=1e-12) and a[k][1] == pytest.approx(b[k][1], abs=1e-12) for k in a)


def test_rounds_average_every_block_and_slice(spark, monkeypatch):
    """The averaged tables equal a plain weighted mean over the blocks' output rows, whatever the slices."""
    monkeypatch.setattr(train, "SLICE_BYTES", 200)
    blocked = _blocked(spark, 200, 30)
    root = tempfile.mkdtemp(prefix="dt-slices-")
    before = init_state(spark, ARGS, [200, 40], root)      # ten items are never touched
    run_round(before, blocked, touched_rows(blocked).checkpoint(), 0, 4, f"{root}/step=0", None, 3)
    after, out = load_model(spark, root, 0), spark.read.parquet(f"{root}/step=0/_round_output")
    for kind, old, new in (("u", before.user_table, after.user_table), ("i", before.item_table, after.item_table)):
        old = {r.bucket: np.array(r.vec) for r in old.collect()}
        sums = {}
        for r in out.where(F.col("kind") == kind).collect():
            w, s = sums.get(r.bucket, (0, 0.0))
            sums[r.bucket] = (w + r.touches, s + r.touches * (np.array(r.vec) - old[r.bucket]))
        got = {r.bucket: r.vec for r in new.collect()}
        assert got.keys() == old.keys()
        for b, vec in got.items():
            w, s = sums.get(b, (1, 0.0))
            assert vec == pytest.approx(old[b] + s / w, abs=1e-12)


def test_later_deltas_replace_rows(spark):
    root = tempfile.mkdtemp(prefix="dt-rows-")
    schema = "bucket long, vec array<double>, g2 double"
    spark.createDataFrame([(k, [float(k), 0.0], 0.0) for k in range(10)], schema).write.parquet(f"{root}/a")
    spark.createDataFrame([(3, [9.0, 9.0], 1.0)], schema).write.parquet(f"{root}/b")
    vecs = {}
    for ids, rows, _ in read_rows([f"{root}/a", f"{root}/b"], 2, 5, 2):
        vecs |= dict(zip(ids.tolist(), rows.tolist()))
    assert vecs == {2: [2.0, 0.0], 3: [9.0, 9.0], 4: [4.0, 0.0]}


def test_a_batch_costs_its_rows_not_the_tables():
    n = 4_000_000
    block = _BlockState(0, 1, 1, None, {})
    part = (np.arange(n), np.zeros((n, 1)), np.zeros(n))
    block.params = {KIND_USER: [part], KIND_ITEM: [part]}
    block._build()
    start = time.perf_counter()
    for k in range(200):
        block.pend_u = block.pend_i = np.array([k])
        block.pend_y = np.array([1.0])
        block._run(1, lambda *_: None)
    assert time.perf_counter() - start < 1
    assert [int(t[-1].sum()) for t in block.tables.values()] == [200, 200]
