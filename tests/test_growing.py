"""The growing index, longer tables for it, and model steps saved as deltas."""

import tempfile

import pytest
from pyspark.sql import functions as F

from duotower.config import TrainArgs
from duotower.operators.index import apply_index, fit_index, grow_index
from duotower.plans.sync_train import train_val_test_sync
from duotower.plans.train import block_examples, init_state, run_round, touched_rows
from duotower.sources.index_store import append_version, index_meta, list_versions, load_index
from duotower.sources.model_store import _delete, compact_step, grow_model, list_steps, load_model, save_model, step_chain

BATCHES = [["b", "b", "a", "c", None], ["d", "a", "a", "a", "e", "e", None, "d"], [], [None, None], ["f", "b"]]


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "userId string").repartition(2)


def folder():
    return tempfile.mkdtemp(prefix="dt-grow-")


def brute(batches):
    index, freq = {}, {}
    for ids in batches:
        counts = {i: ids.count(i) for i in set(ids) - {None}}
        for i in sorted(set(counts) - set(index), key=lambda i: (-counts[i], i)):
            index[i] = len(index)
        for i, n in counts.items():
            freq[i] = freq.get(i, 0) + n
    return {(i, k, freq[i]) for i, k in index.items()}


def rows_of(model):
    return {tuple(r) for r in model.table.select("userId", "index", "freq").collect()}


def test_grown_index_equals_brute_force(spark):
    model = fit_index(frame(spark, BATCHES[0]), "userId", 3)
    for k, ids in enumerate(BATCHES[1:], 2):
        model = grow_index(model, frame(spark, ids), 3)
        assert rows_of(model) == brute(BATCHES[:k])
    assert {tuple(r) for r in apply_index(frame(spark, ["b", "f", "x"]), model, "keep").collect()} == {(0,), (5,), (6,)}


def test_stored_index_reads_every_version(spark):
    root = folder()
    for k, ids in enumerate(BATCHES):
        assert append_version(frame(spark, ids), "userId", root, 3, f"b{k}") == k
    assert append_version(frame(spark, BATCHES[1]), "userId", root, 3, "b1") == 1       # a retried batch counts once
    for k in range(len(BATCHES)):
        assert rows_of(load_index(spark, root, k)) == brute(BATCHES[:k + 1])
    meta = index_meta(spark, root).orderBy("version").select("first", "n_new").collect()
    assert [tuple(r) for r in meta] == [(0, 3), (3, 2), (5, 0), (5, 0), (5, 1)]
    with pytest.raises(ValueError):
        load_index(spark, root, 9)
    with pytest.raises(ValueError):
        append_version(frame(spark, ["z"]).withColumnRenamed("userId", "other"), "other", root, 3, "z")


def test_index_store_starts_empty_and_survives_a_cut_off_append(spark):
    root = folder()
    append_version(frame(spark, []), "userId", root, 3, "none")
    append_version(frame(spark, BATCHES[0]), "userId", root, 3, "b0")
    append_version(frame(spark, BATCHES[1]), "userId", root, 3, "b1")
    _delete(spark, f"{root}/version=2/meta")
    assert list_versions(spark, root) == [0, 1] and rows_of(load_index(spark, root)) == brute(BATCHES[:1])
    assert append_version(frame(spark, BATCHES[4]), "userId", root, 3, "b4") == 2
    assert rows_of(load_index(spark, root)) == brute([BATCHES[0], BATCHES[4]])


def vectors(table):
    return {r["bucket"]: (list(r["vec"]), r["g2"]) for r in table.collect()}


def test_grown_model_keeps_its_rows(spark):
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2))
    root = folder()
    state = init_state(spark, args, [5, 6], root)
    save_model(grow_model(state, [9, 6]), root, "grown")
    grown = load_model(spark, root, "grown")
    old, new = vectors(state.user_table), vectors(grown.user_table)
    assert grown.emb_counts == [9, 6] and sorted(new) == list(range(9)) and all(new[b] == old[b] for b in old)
    assert vectors(grown.item_table) == vectors(state.item_table)
    with pytest.raises(ValueError):
        grow_model(state, [4, 6])


@pytest.fixture(scope="module")
def examples(spark):
    """1,200 rows of few users and items per part, so that a round leaves most rows of the tables alone."""
    return spark.range(1200).select((F.col("id") % 37 + 1).alias("userId"), (F.col("id") * 7 % 53 + 1).alias("movieId"),
                                    (F.col("id") % 3 % 2).cast("int").alias("label"), F.col("id").alias("row_id"))


def trained_steps(spark, examples, full_every):
    args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=64, n_blocks=2, rounds_per_epoch=1, full_every=full_every)
    root = folder()
    state = init_state(spark, args, [200, 300], root)
    few = [examples.where((F.col("row_id") >= 10 * s) & (F.col("row_id") < 10 * s + 25)) for s in range(5)]
    for s, ex in enumerate(few):
        blocked = block_examples(ex, args, [200, 300], 2).checkpoint()
        state = run_round(state, blocked, touched_rows(blocked).checkpoint(), 0, 2, f"{root}/step={s}", None, s).state
    return root


def test_delta_steps_equal_full_steps(spark, examples):
    full, delta = trained_steps(spark, examples, 1), trained_steps(spark, examples, 3)
    depths = []
    for s in range(5):
        a, b = load_model(spark, full, s), load_model(spark, delta, s)
        depths.append(b.depth)
        assert a.depth == 0 and a.adam_t == b.adam_t
        for x, y in ((a.user_table, b.user_table), (a.item_table, b.item_table)):
            want, got = vectors(x), vectors(y)
            assert want.keys() == got.keys()
            assert all(got[k][0] == pytest.approx(want[k][0], abs=1e-12) and got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in want)
    assert depths == [1, 2, 0, 1, 2]
    assert spark.read.parquet(f"{delta}/step=1/user_delta").count() == 25       # the touched users of 200


def test_compacted_step_needs_no_parent(spark, examples):
    root = trained_steps(spark, examples, 4)
    path = f"{root}/step=1"
    before = load_model(spark, root, 1)
    users, items = vectors(before.user_table), vectors(before.item_table)
    assert step_chain(spark, path) == [path, f"{root}/step=0", f"{root}/step=base"]
    compact_step(spark, path)
    compact_step(spark, path)       # nothing left to do
    for name in ("base", "0"):
        _delete(spark, f"{root}/step={name}")
    after = load_model(spark, root, 1)
    assert after.depth == 0 and vectors(after.user_table) == users and vectors(after.item_table) == items
    assert load_model(spark, root, 2).depth == 1


def test_sync_chunks_keep_what_a_delta_needs(spark, examples):
    def run(full_every):
        args = TrainArgs(embedding_dim=4, layer_sizes=(4, 2), batch_size=128, epochs=2, validation_freq=2, full_every=full_every)
        root = folder()
        part = examples.where("row_id < 900")
        state, metrics = train_val_test_sync(spark, part, examples.where("row_id >= 900"), examples.where("row_id >= 900"), args, [200, 300], root, "r", 2)
        return root, vectors(state.user_table), metrics.where("phase = 'val_step'").count()

    (root_a, users_a, n_a), (root_b, users_b, n_b) = run(1), run(3)
    assert n_a == n_b > 2 and users_a.keys() == users_b.keys()
    assert all(users_b[k][0] == pytest.approx(users_a[k][0], abs=1e-9) for k in users_a)
    for root in (root_a, root_b):       # epochs are full steps, and no chunk outlives its epoch
        assert [load_model(spark, f"{root}/model", e).depth for e in (0, 1)] == [0, 0] and list_steps(spark, f"{root}/chunks") == []
