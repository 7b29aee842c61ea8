"""Distributed training of the two-tower model (M4-M8), evaluation (A9) and the full loop (M7).

One training round is one Spark job (parameter averaging, McDonald et al. 2010;
blocking as in stratified SGD, Gemulla et al. 2011):

1. Every example gets a block. Ordinary users: ``pmod(user_bucket, n_blocks)``,
   so all rows of a user meet in one task and that user's row is updated by
   exactly one task. Hot users (more than ``hot_user_rows`` rows) and rows
   without a user are spread by a hash of their stable row id instead, so no
   block holds a third of the data because of one user.
2. Each block holds copies of exactly the table rows its examples touch. Their keys, ``distinct(block, bucket)``, come
   to its task; a table of which the blocks touch most rows each (items, as a rule) is then read by the task from the
   saved step in the shared folder, so its many copies are neither shuffled nor sorted. Of other tables the rows are joined
   to the keys and come with them. Tables are never broadcast whole.
   With ``item_blocks = C > 1`` (item strata, DSGD), an epoch has C rounds and
   in round s user block u only trains on items of block (u + s) mod C, so a
   task holds at most ~1/C of the item table and, with ``n_blocks = C``, no
   two tasks of a round share an item.
3. Examples and their table rows are unioned, hash-partitioned by block and
   sorted by (block, table rows first, seeded order); ``mapInArrow`` streams
   each partition. Per block only its table rows are held in memory; the
   examples stream through mini-batches of ``batch_size`` with row-wise
   Adagrad on table rows and Adam on the tower weights. Every block starts from
   the round's weights and Adam state and has a task of its own, so the result
   does not depend on tasks or cluster settings. A block emits per touched row
   (new values, touches), in the order of the buckets, plus one row with its final tower weights.
4. Deltas of a row that several blocks touched are averaged weighted by
   touches: a task takes a range of buckets and reads it from the old table and from every block's output,
   whose row groups are pruned by that range. Tower weights are averaged weighted by rows with ``Summarizer.mean``.
   The new tables are written to the shared folder and read back, which also
   cuts the lineage.

With ``n_blocks = 1`` a round is exactly sequential mini-batch training. The number of blocks comes from the
arguments alone. Rows without a label are not trained. ``validation_freq`` counts mini-batches and is looked at after
every round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.config import TrainArgs, relevant_fields, validate_model
from duotower.functions.gradients import Adam, flatten_grads, rowwise_adagrad, two_tower_step
from duotower.operators.buckets import sparse_features
from duotower.operators.lookup import cell_plan, dealt_cells
from duotower.operators.metrics import eval_summary
from duotower.operators.scorer import block_counts, score_by_blocks
from duotower.operators.towers import DenseParams, _arrow_lists, init_table, referenced_rows, score_pairs
from duotower.sources.model_store import (TABLES, ModelState, _delete, list_steps, load_model, read_into, read_rows, save_model, save_step,
                                          step_tables, table_files)
from duotower.snapshot import snapshot
from duotower.sources.runs import log_metrics, log_params, read_metrics
from duotower.streaming.batches import assign_batches, limit_batches

CAT_COLS = ["userId", "movieId"]
ROUND_SCHEMA = ("kind string, bucket long, vec array<double>, aux array<double>, g2 double, touches long, "
                "loss_sum double, n_rows long, batch_mean_sum double, n_batches long, steps long")


BROADCAST_HOT = 10_000           # rows of a hot user from which on the hot users are broadcast: one in as many rows at most
READS_PER_COPY = 2              # rows of a table that all blocks together read, per row they touch, up to which they read it
SLICE_BYTES = 64 << 20          # bytes of vectors of a bucket range when deltas are averaged
ROW_GROUP_BYTES = 16 << 20      # of a block's output


# ------------------------------------------------------------------ set-up

def with_buckets(df: DataFrame, emb_counts, zero_is_missing: bool = True) -> DataFrame:
    """P8 with the bucket columns named ``user_bucket`` / ``item_bucket``."""
    out = sparse_features(df, CAT_COLS, emb_counts, zero_is_missing)
    return out.withColumnRenamed("userId_bucket", "user_bucket").withColumnRenamed("movieId_bucket", "item_bucket")


def init_state(spark: SparkSession, args: TrainArgs, emb_counts, root: str | None = None) -> ModelState:
    """M1: fresh tables and towers. With ``root``, the state is saved as ``step=base`` and read back,
    so the hash-derived initial tables are computed once instead of in every later plan."""
    validate_model(CAT_COLS, emb_counts, [args.embedding_dim, args.embedding_dim])
    users = init_table(spark, f"t_{CAT_COLS[0]}", int(emb_counts[0]), args.embedding_dim, args.seed)
    items = init_table(spark, f"t_{CAT_COLS[1]}", int(emb_counts[1]), args.embedding_dim, args.seed)
    dense = DenseParams.init(args.seed, args.embedding_dim, args.layer_sizes, args.final_activation)
    state = ModelState(users, items, dense, None, None, 0, args, list(CAT_COLS), [int(c) for c in emb_counts])
    if root is None:
        return state
    save_model(state, root, "base")
    return load_model(spark, root, "base")


def block_examples(train: DataFrame, args: TrainArgs, emb_counts, n_blocks: int) -> DataFrame:
    """Step 1: (block, part, user_bucket, item_bucket, label, row_id) of the rows that have a label."""
    train = train.where(F.col("label").isNotNull())
    ex = with_buckets(train, emb_counts, args.zero_is_missing).select("user_bucket", "item_bucket", "label", "row_id")
    hot = (ex.where(F.col("user_bucket").isNotNull()).groupBy("user_bucket").agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > args.hot_user_rows).select("user_bucket", F.lit(True).alias("_hot")))
    # rows without a user meet no hot user: a spread negative key keeps them out of one partition
    key = F.coalesce("user_bucket", -1 - F.pmod(F.xxhash64("row_id"), F.lit(4096)))
    hot = hot.withColumnRenamed("user_bucket", "_key")
    if args.hot_user_rows >= BROADCAST_HOT:     # then they are few, and the examples need no shuffle to meet them
        hot = F.broadcast(hot)
    ex = ex.withColumn("_key", key).join(hot, "_key", "left")
    salted = F.pmod(F.xxhash64(F.col("row_id"), F.lit(args.seed)), F.lit(n_blocks))
    block = F.when(F.col("user_bucket").isNull() | F.col("_hot").isNotNull(), salted).otherwise(
        F.pmod(F.col("user_bucket"), F.lit(n_blocks)))
    if args.item_blocks > 1:
        # item strata: round s of an epoch pairs user block u with item block (u + s) mod C
        c = F.lit(args.item_blocks)
        item_block = F.when(F.col("item_bucket").isNull(), F.pmod(F.xxhash64(F.col("row_id"), F.lit(args.seed + 2)), c)
                            ).otherwise(F.pmod(F.xxhash64(F.col("item_bucket")), c))
        part = F.pmod(item_block - F.pmod(block, c), c)
    else:
        part = F.pmod(F.xxhash64(F.col("row_id"), F.lit(args.seed + 1)), F.lit(args.rounds_per_epoch))
    return ex.select(block.cast("int").alias("block"), part.cast("int").alias("part"), "user_bucket", "item_bucket",
                     F.col("label").cast("int").alias("label"), "row_id")


def touched_rows(blocked: DataFrame) -> DataFrame:
    """Step 2 keys: distinct (part, block, kind, bucket) for the user and item tables."""
    u = blocked.where(F.col("user_bucket").isNotNull()).select("part", "block", F.lit("u").alias("kind"),
                                                               F.col("user_bucket").alias("bucket"))
    i = blocked.where(F.col("item_bucket").isNotNull()).select("part", "block", F.lit("i").alias("kind"),
                                                               F.col("item_bucket").alias("bucket"))
    return u.unionByName(i).distinct()


def block_report(blocked: DataFrame) -> DataFrame:
    """Where the work went (the Spark counterpart of printing a sharding plan), per (round part, block).

    Rows, distinct users and items, and the hot (salted) share: a skew check before training.
    """
    # two aggregates, not two distinct counts in one: for those Spark would write every row three times
    users = blocked.groupBy("part", "block", "user_bucket").agg(F.count(F.lit(1)).alias("_n"))
    items = blocked.select("part", "block", "item_bucket").distinct()
    by_user = users.groupBy("part", "block").agg(
        F.sum("_n").alias("rows"), F.count("user_bucket").alias("users"),
        F.sum(F.when(F.col("user_bucket").isNull(), F.col("_n")).otherwise(0)).alias("rows_without_user"))
    by_item = items.groupBy("part", "block").agg(F.count("item_bucket").alias("items"))
    return by_user.join(by_item, ["part", "block"]).select("part", "block", "rows", "users", "items", "rows_without_user")


# ------------------------------------------------------------------ the task

KIND_USER, KIND_ITEM, KIND_EXAMPLE = 0, 1, 2
OUT_ROWS = 8192
STREAM_COLS = ["block", "kind", "ord", "user_bucket", "item_bucket", "label", "bucket", "vec", "g2"]
_OUT_COLS = [c.split()[0] for c in ROUND_SCHEMA.split(", ")]


class _BlockState:
    """One block inside a task: its table rows, then its examples streamed in mini-batches.

    ``stored`` has the files of the tables of which only keys come with the block. Of either table one copy is held.
    """

    def __init__(self, block: int, dim: int, batch: int, max_batches: int | None, stored: dict):
        self.block, self.dim, self.batch, self.max_batches, self.stored = block, dim, batch, max_batches, stored
        self.params = {KIND_USER: [], KIND_ITEM: []}
        self.ready = False
        self.pend_u = self.pend_i = np.empty(0, dtype=np.int64)
        self.pend_y = np.empty(0)
        self.batches = 0

    def _build(self):
        self.tables = {}
        for kind, parts in self.params.items():
            ids = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, dtype=np.int64)
            tab, g2 = np.zeros((len(ids) + 1, self.dim)), np.zeros(len(ids))        # last row: zeros for a missing id
            if kind in self.stored:
                known = read_into(self.stored[kind], ids, tab, g2)
                if not known.all():
                    ids, tab, g2 = ids[known], tab[np.r_[known, True]], g2[known]
            else:
                at = 0
                while parts:
                    _, vecs, sums = parts.pop(0)
                    tab[at:at + len(vecs)], g2[at:at + len(vecs)] = vecs, sums
                    at += len(vecs)
            self.tables[kind] = [pd.Index(ids), tab, g2, np.zeros(len(ids), dtype=np.int64)]
        self.params = None
        self.ready = True

    def feed(self, cols: dict, lo: int, hi: int, step):
        kinds = cols["kind"][lo:hi]
        for kind in (KIND_USER, KIND_ITEM):
            sel = np.flatnonzero(kinds == kind)
            if len(sel):
                rows = sel + lo
                vecs = None if kind in self.stored else cols["vecs"][cols["vec_row"][rows]]
                self.params[kind].append((cols["bucket"][rows], vecs, cols["g2"][rows]))
        ex = np.flatnonzero(kinds == KIND_EXAMPLE) + lo
        if not len(ex) or not self._may_run():       # past the batch limit: nothing more is kept in memory
            return
        if not self.ready:
            self._build()
        ui, ii = self.tables[KIND_USER][0], self.tables[KIND_ITEM][0]
        self.pend_u = np.concatenate([self.pend_u, ui.get_indexer(cols["user_bucket"][ex])])
        self.pend_i = np.concatenate([self.pend_i, ii.get_indexer(cols["item_bucket"][ex])])
        self.pend_y = np.concatenate([self.pend_y, cols["label"][ex]])
        while len(self.pend_y) >= self.batch and self._may_run():
            self._run(self.batch, step)

    def _may_run(self) -> bool:
        return self.max_batches is None or self.batches < self.max_batches

    def _run(self, n: int, step):
        ru, ri, y = self.pend_u[:n], self.pend_i[:n], self.pend_y[:n]
        self.pend_u, self.pend_i, self.pend_y = self.pend_u[n:], self.pend_i[n:], self.pend_y[n:]
        tu, ti = self.tables[KIND_USER], self.tables[KIND_ITEM]
        step(ru, ri, y, tu[1], tu[2], ti[1], ti[2])
        for t, r in ((tu, ru), (ti, ri)):
            np.add.at(t[3], r[r >= 0], 1)       # work by the batch's rows, not by the table's
        self.batches += 1

    def finish(self, step):
        if not self.ready:
            self._build()
        if len(self.pend_y) and self._may_run():
            self._run(len(self.pend_y), step)
        for kind, name in ((KIND_USER, "u"), (KIND_ITEM, "i")):
            idx, tab, g2, touches = self.tables[kind]
            hit = np.nonzero(touches)[0]
            hit = hit[np.argsort(idx.values[hit], kind="stable")]
            for lo in range(0, len(hit), OUT_ROWS):
                k = hit[lo:lo + OUT_ROWS]
                yield _out_batch(name, idx.values[k], tab[k], g2[k], touches[k])


def _out_batch(kind: str, buckets, vecs, g2, touches) -> pa.RecordBatch:
    n = len(buckets)
    none_d, none_l = pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n), pa.array(buckets, pa.int64()), _arrow_lists(np.asarray(vecs, dtype=np.float64)),
         pa.nulls(n, pa.list_(pa.float64())), pa.array(g2, pa.float64()), pa.array(touches, pa.int64()),
         none_d, none_l, none_d, none_l, none_l], names=_OUT_COLS)


def _summary_batch(theta, aux, rows, batches, loss, mean) -> pa.RecordBatch:
    d = np.asarray(theta, dtype=np.float64)
    lists = pa.array([d.tolist(), None], pa.list_(pa.float64()))
    auxl = pa.array([None if aux is None else np.asarray(aux).tolist(), None], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(["d", "s"]), pa.nulls(2, pa.int64()), lists, auxl, pa.nulls(2, pa.float64()),
         pa.array([rows, None], pa.int64()), pa.array([None, loss], pa.float64()), pa.array([None, rows], pa.int64()),
         pa.array([None, mean], pa.float64()), pa.array([None, batches], pa.int64()),
         pa.array([batches, None], pa.int64())], names=_OUT_COLS)


def _batch_columns(batch: pa.RecordBatch, dim: int) -> dict:
    def num(name, fill, dtype):
        return batch.column(name).fill_null(fill).to_numpy(zero_copy_only=False).astype(dtype, copy=False)

    vec = batch.column("vec")
    present = vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) > 0
    vecs = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)
    return {"block": num("block", -1, np.int64), "kind": num("kind", -1, np.int64),
            "user_bucket": num("user_bucket", -1, np.int64), "item_bucket": num("item_bucket", -1, np.int64),
            "label": num("label", 0, np.float64), "bucket": num("bucket", -1, np.int64),
            "g2": num("g2", 0.0, np.float64), "vecs": vecs, "vec_row": np.cumsum(present) - 1}


def batch_caps(limit: int, batches: dict[int, int]) -> dict[int, int]:
    """Mini-batches each block may run so that all together run ``limit`` (or all they have): equal shares first."""
    caps = dict.fromkeys(batches, 0)
    left = limit
    open_blocks = sorted(b for b, n in batches.items() if n)
    while left and open_blocks:
        share = max(1, left // len(open_blocks))
        for b in open_blocks:
            more = min(share, batches[b] - caps[b], left)
            caps[b] += more
            left -= more
        open_blocks = [b for b in open_blocks if caps[b] < batches[b]]
    return caps


def _round_fn(args: TrainArgs, template: DenseParams, start, t: int, caps: dict | None, stored: dict):
    """``mapInArrow`` body: blocks arrive contiguous, each as its table rows then its examples in order.

    Vectors are read from the Arrow list buffers as NumPy matrices (no per-row
    objects). ``start`` is a broadcast of (tower weights, Adam m, Adam v), shipped
    once per executor. Every block starts from them and emits one row with its own.
    """
    dim, batch = args.embedding_dim, args.batch_size
    final_relu = args.final_activation == "relu"

    def fn(batches):
        theta, m, v = start.value
        st = {}

        def begin():
            st.update(th=theta.copy(), loss=0.0, mean=0.0, rows=0, batches=0, opt=Adam(
                args.learning_rate, args.adam_betas, args.adam_eps, None if m is None else m.copy(), None if v is None else v.copy(), t))
            st["dense"] = template.with_flat(st["th"])

        def end(block):
            yield from block.finish(step)
            opt = st["opt"]
            aux = None if opt.m is None else np.concatenate([opt.m, opt.v])
            yield _summary_batch(st["th"], aux, st["rows"], st["batches"], st["loss"], st["mean"])

        def step(ru, ri, y, U, gu, I, gi):
            eu, ei = U[np.where(ru >= 0, ru, len(U) - 1)], I[np.where(ri >= 0, ri, len(I) - 1)]
            d = st["dense"]
            losses, gq, gc, deu, dei = two_tower_step(eu, ei, y, d.query, d.candidate, final_relu)
            rowwise_adagrad(U, gu, ru, deu, args.table_lr, args.adagrad_eps)
            rowwise_adagrad(I, gi, ri, dei, args.table_lr, args.adagrad_eps)
            st["th"] = st["opt"].step(st["th"], flatten_grads(gq, gc))
            st["dense"] = template.with_flat(st["th"])
            st["loss"] += float(losses.sum())
            st["mean"] += float(losses.mean())
            st["rows"] += len(y)
            st["batches"] += 1

        cur = None
        for rb in batches:
            if rb.num_rows == 0:
                continue
            cols = _batch_columns(rb, dim)
            blocks = cols["block"]
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(blocks)]):
                b = int(blocks[lo])
                if cur is None or cur.block != b:
                    if cur is not None:
                        yield from end(cur)
                    begin()
                    cur = _BlockState(b, dim, batch, None if caps is None else caps.get(b, 0), stored)
                cur.feed(cols, int(lo), int(hi), step)
        if cur is not None:
            yield from end(cur)

    return fn


def round_input(blocked: DataFrame, params: DataFrame, order_seed: int) -> DataFrame:
    """Examples and the table rows they touch in one frame: (block, kind, ord, ...).

    Examples have an empty vector, not a null one: Spark's Arrow writer walks over all null lists of a batch again at every row.
    """
    null_long, no_vec = F.lit(None).cast("long"), F.array().cast("array<double>")
    ex = blocked.select("block", F.lit(KIND_EXAMPLE).alias("kind"),
                        F.xxhash64(F.col("row_id"), F.lit(order_seed)).alias("ord"), "user_bucket", "item_bucket",
                        "label", null_long.alias("bucket"), no_vec.alias("vec"),
                        F.lit(None).cast("double").alias("g2"), "row_id")
    pr = params.select(F.col("pblock").alias("block"),
                       F.when(F.col("kind") == "u", F.lit(KIND_USER)).otherwise(F.lit(KIND_ITEM)).alias("kind"),
                       F.lit(0).cast("long").alias("ord"), null_long.alias("user_bucket"),
                       null_long.alias("item_bucket"), F.lit(None).cast("int").alias("label"), "bucket",
                       "vec", "g2", F.col("bucket").alias("row_id"))
    return ex.unionByName(pr)


# ------------------------------------------------------------------ reduce

def averaged_rows(state: ModelState, files: list[str], kind: str, output: str, touched_only: bool = False) -> DataFrame:
    """Step 4 for one table: (bucket, vec, g2) with the touch-weighted mean of the blocks' deltas added.

    A task takes a range of buckets of about ``SLICE_BYTES``. It reads the old rows (``files``) and every block's new
    rows (``output``) of that range in turn, so no vector is shuffled. ``touched_only`` gives the changed rows only.
    """
    spark, dim = state.user_table.sparkSession, state.args.embedding_dim
    count = int(state.emb_counts[0 if kind == "u" else 1])
    n = max(1, math.ceil(count * (dim * 8 + 32) / SLICE_BYTES), min(count, 2 * spark.sparkContext.defaultParallelism))
    width = math.ceil(count / n)

    def run(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield from _averaged_slice(files, output, kind, k * width, (k + 1) * width, dim, touched_only)

    return spark.range(0, n, 1, n).mapInArrow(run, "bucket long, vec array<double>, g2 double")


def _averaged_slice(files: list[str], output: str, kind: str, lo: int, hi: int, dim: int, touched_only: bool):
    old = list(read_rows(files, lo, hi, dim))
    if not old:
        return
    ids = np.unique(np.concatenate([r[0] for r in old]))
    tab, g2 = np.zeros((len(ids), dim)), np.zeros(len(ids))
    while old:
        bucket, vecs, sums = old.pop(0)
        at = np.searchsorted(ids, bucket)
        tab[at], g2[at] = vecs, sums
    weight, add, add_g2 = np.zeros(len(ids)), np.zeros_like(tab), np.zeros(len(ids))
    for bucket, vecs, sums, touches in read_rows([output], lo, hi, dim, kind):
        at = np.searchsorted(ids, bucket)
        w = touches.astype(np.float64)
        np.add.at(weight, at, w)
        np.add.at(add_g2, at, w * (sums - g2[at]))
        delta = w[:, None] * (vecs - tab[at])
        if (np.diff(at) > 0).all():     # the rows of one block
            add[at] += delta
        else:
            np.add.at(add, at, delta)
    hit = weight > 0
    tab[hit] += add[hit] / weight[hit][:, None]
    g2[hit] += add_g2[hit] / weight[hit]
    rows = np.flatnonzero(hit) if touched_only else np.arange(len(ids))
    for at in range(0, len(rows), OUT_ROWS):
        k = rows[at:at + OUT_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(ids[k]), _arrow_lists(tab[k]), pa.array(g2[k])], names=["bucket", "vec", "g2"])


def average_dense(dense_rows: DataFrame):
    """Row-weighted mean of the blocks' tower weights and Adam moments (``Summarizer.mean``, map-side combined).

    The result has the fixed size of the model config (weights + two moments) and is the one thing collected.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    x = dense_rows.where(F.col("touches") > 0).select(
        F.col("touches").cast("double").alias("w"),
        array_to_vector(F.concat("vec", F.coalesce("aux", F.array().cast("array<double>")))).alias("v"))
    row = x.agg(Summarizer.mean(F.col("v"), F.col("w")).alias("m")).first()
    return np.array([]) if row is None or row["m"] is None else row["m"].toArray()


@dataclass
class RoundResult:
    state: ModelState
    loss: float | None
    avg_loss_compat: float | None
    n_rows: int
    n_batches: int


def run_round(state: ModelState, blocked: DataFrame, keys: DataFrame, part: int, n_blocks: int, out_path: str,
              limit: int | None, order_seed: int) -> RoundResult:
    """One training round over the examples of ``part`` (steps 2-4 of the module docstring).

    ``out_path`` must end in ``step=<name>``: the new state is saved there
    (``name`` numeric for epoch steps) and its tables are read back.
    Every block has a task of its own. ``limit`` is the number of mini-batches of the round, handed out to the
    blocks by their measured sizes.
    """
    spark = blocked.sparkSession
    args, dim = state.args, state.args.embedding_dim
    ex = blocked.where(F.col("part") == part).select("block", "user_bucket", "item_bucket", "label", "row_id")
    k = keys.where(F.col("part") == part)
    tables = {"u": state.user_table, "i": state.item_table}
    files = dict(zip("ui", table_files(spark, state)))
    copies = {r["kind"]: r["count"] for r in k.groupBy("kind").count().collect()}       # two rows
    stored = [kind for kind, n in zip("ui", state.emb_counts) if n_blocks * n <= READS_PER_COPY * copies.get(kind, 0)]
    no_vec = [F.array().cast("array<double>").alias("vec"), F.lit(0.0).alias("g2")]
    parts = [k.where(F.col("kind") == kind).select("*", *no_vec) if kind in stored else
             k.where(F.col("kind") == kind).join(table.select("bucket", "vec", "g2"), "bucket") for kind, table in tables.items()]
    params = parts[0].unionByName(parts[1]).select(F.col("block").alias("pblock"), "kind", "bucket", "vec", "g2")
    theta = state.dense.flat()
    start = spark.sparkContext.broadcast((theta, state.adam_m, state.adam_v))
    caps = None
    if limit is not None:       # one row per block
        sizes = {r["block"]: math.ceil(r["count"] / args.batch_size) for r in ex.groupBy("block").count().collect()}
        caps = batch_caps(limit, sizes)
    fn = _round_fn(args, state.dense, start, state.adam_t, caps, {"ui".index(kind): files[kind] for kind in stored})
    rows = (round_input(ex, params, order_seed).repartitionById(n_blocks, "block")
            .sortWithinPartitions("block", "kind", "ord", "row_id").select(*STREAM_COLS))
    out = rows.mapInArrow(fn, ROUND_SCHEMA)
    # not by folders of ``kind``: Spark would sort (and spill) the vectors for that; small row groups are pruned by their buckets
    output = f"{out_path}/_round_output"
    out.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(output)
    start.unpersist()
    o = spark.read.schema(ROUND_SCHEMA).parquet(output)
    stats = o.where(F.col("kind") == "s").agg(F.sum("loss_sum").alias("l"), F.sum("n_rows").alias("n"),
                                              F.sum("batch_mean_sum").alias("bm"),
                                              F.sum("n_batches").alias("nb"), F.max("n_batches").alias("steps")).first()
    n_rows = int(stats["n"] or 0)
    flat = average_dense(o.where(F.col("kind") == "d"))
    n_theta = theta.size
    if n_rows > 0 and flat.size >= n_theta:
        dense = state.dense.with_flat(flat[:n_theta])
        m_new = flat[n_theta:2 * n_theta] if flat.size >= 3 * n_theta else state.adam_m
        v_new = flat[2 * n_theta:3 * n_theta] if flat.size >= 3 * n_theta else state.adam_v
        steps = stats["steps"] or 0
    else:
        dense, m_new, v_new, steps = state.dense, state.adam_m, state.adam_v, 0
    new = ModelState(*[averaged_rows(state, files[kind], kind, output) for kind in "ui"],
                     dense, m_new, v_new, state.adam_t + int(steps), args, state.cat_cols, state.emb_counts, state.step)
    step = out_path.rsplit("=", 1)[1]
    changed = {t: averaged_rows(state, files[t[0]], t[0], output, True) for t in TABLES}
    path = save_step(new, state, changed, out_path.rsplit("/", 1)[0], step, args.full_every)
    # read the tables back (cuts the lineage); the small parts are already in memory
    users, items, depth = step_tables(spark, path)
    reloaded = ModelState(users, items, new.dense, new.adam_m, new.adam_v, new.adam_t, args, state.cat_cols, state.emb_counts,
                          int(step) if step.isdigit() else step, path, depth)
    loss = (stats["l"] / n_rows) if n_rows else None
    compat = (stats["bm"] / n_rows) if n_rows else 0.0
    return RoundResult(reloaded, loss, compat, n_rows, int(stats["nb"] or 0))


# ------------------------------------------------------------------ evaluation

def score_split(state: ModelState, split_df: DataFrame, phase: str, limit: int | None = None,
                n_shards: int | None = None) -> DataFrame:
    """R0 over an exported split: buckets, batch stream, tower outputs, logit/prob/pred.

    The batch stream has ``n_shards`` shard windows (default: ``eval_shards`` of the run's arguments), so which rows a
    batch limit keeps does not depend on the cluster. Use more shards for a larger split.
    With a batch ``limit`` the towers only run on the table rows those batches use.
    """
    b = batched_split(split_df, state.args, state.emb_counts, limit, n_shards)
    return score_batches(state, b if limit is None else b.checkpoint(), phase, limit)


def batched_split(split_df: DataFrame, args: TrainArgs, emb_counts, limit: int | None = None, n_shards: int | None = None) -> DataFrame:
    """The first half of ``score_split``, the same for every state of a run: buckets and the batch stream."""
    ex = with_buckets(split_df, emb_counts, args.zero_is_missing)
    return limit_batches(assign_batches(ex, ["row_id"], args.batch_size, n_shards or args.eval_shards, args.seed), limit)


def score_batches(state: ModelState, b: DataFrame, phase: str, limit: int | None = None) -> DataFrame:
    """The second half: the rows of ``batched_split`` scored by a state."""
    users, items = state.user_table, state.item_table
    if limit is not None:
        users, items = referenced_rows(users, b, "user_bucket"), referenced_rows(items, b, "item_bucket")
    return score_pairs(b, users, items, state.dense, state.args.embedding_dim).withColumn("phase", F.lit(phase))


def evaluate(state: ModelState, split_df: DataFrame, phase: str, limit: int | None = None) -> dict:
    """{n_rows, mean_bce, avg_loss_compat, n_batches, auroc} for one split."""
    return _summary(score_split(state, split_df, phase, limit))


def written_split(split_df: DataFrame, args: TrainArgs, emb_counts, limit: int | None = None) -> DataFrame:
    """The rows of ``batched_split`` written once for several states; without a limit, rows of the same blocks together."""
    b = batched_split(split_df, args, emb_counts, limit).select("user_bucket", "item_bucket", "label", "batch_seq")
    blocks = block_counts(args, emb_counts)
    if limit is None and max(blocks) > 1:
        rows, cells, _ = cell_plan(b, ["user_bucket", "item_bucket"], list(blocks))
        b = dealt_cells(rows, cells).drop("_cell") if cells else b
    return snapshot(b, "split_rows")


def evaluate_batches(state: ModelState, b: DataFrame, phase: str, limit: int | None = None) -> dict:
    """``evaluate`` of the rows of ``written_split``. Without a limit the towers' outputs are read by blocks, and no row carries a vector."""
    if limit is not None:
        return _summary(score_batches(state, b, phase, limit))
    rows, written = score_by_blocks(state, b, block_counts(state.args, state.emb_counts))
    found = _summary(rows.withColumn("phase", F.lit(phase)))
    for path in written:        # a validation leaves no copy of the tables
        _delete(state.user_table.sparkSession, path)
    return found


def _summary(rows: DataFrame) -> dict:
    # Score once into a narrow snapshot; the three metrics then read it instead of re-running the joins.
    scored = snapshot(rows.select("phase", "label", "logit", "batch_seq"), "scored")
    return summary_values(eval_summary(scored, ["phase"]).first())


def summary_values(r) -> dict:
    """A row of ``eval_summary``, or what stands for no rows."""
    if r is None:
        return {"n_rows": 0, "mean_bce": None, "avg_loss_compat": 0.0, "n_batches": 0, "auroc": None}
    return {k: r[k] for k in ("n_rows", "mean_bce", "avg_loss_compat", "n_batches", "auroc")}


# ------------------------------------------------------------------ the loop

def choose_blocks(args: TrainArgs) -> int:
    """User blocks, from the arguments alone: ``n_blocks``, and one per item block at least.

    ``block_report`` shows the rows and table rows of each block before a long run.
    """
    return max(1, args.n_blocks, args.item_blocks)


def train_val_test(spark: SparkSession, train: DataFrame, val: DataFrame, test: DataFrame, args: TrainArgs,
                   emb_counts, root: str, run_id: str, resume: bool = False) -> tuple[ModelState, DataFrame]:
    """M7: base validation, epochs x (rounds, validation, save), then test. Returns (model, run_metrics).

    ``train``/``val``/``test`` are exported splits read with ``read_shards`` (they carry ``row_id``).
    ``resume=True`` continues a run whose driver stopped: training restarts after the latest saved
    complete epoch step under ``root/model`` (a step that was cut off half-way is not counted and is written anew).
    An epoch whose validation was not logged any more is validated again first.
    """
    model_root = f"{root}/model"
    done_epochs = sorted(int(x) for x in list_steps(spark, model_root) if x.isdigit()) if resume else []
    if done_epochs:
        state = load_model(spark, model_root, done_epochs[-1])
        first_epoch = done_epochs[-1] + 1
        logged = read_metrics(spark, root).where((F.col("run_id") == run_id) & (F.col("phase") == "epoch")
                                                 & (F.col("step") == done_epochs[-1]))
        if logged.limit(1).count() == 0:
            log_metrics(spark, root, run_id, "epoch", done_epochs[-1], _named("val", evaluate(state, val, "val", args.limit_val_batches)))
    else:
        state = init_state(spark, args, emb_counts, model_root)
        first_epoch = 0
        log_params(spark, root, run_id, relevant_fields(args, CAT_COLS, emb_counts))
        log_metrics(spark, root, run_id, "base", None,
                    _named("val", evaluate(state, val, "val", args.limit_val_batches)))

    n_blocks = choose_blocks(args)
    blocked = snapshot(block_examples(train, args, emb_counts, n_blocks), "blocked")
    keys = touched_rows(blocked).checkpoint()
    rounds, batches = first_epoch * args.rounds, 0
    for epoch in range(first_epoch, args.epochs):
        left = args.limit_train_batches     # mini-batches that the epoch may still run
        for part in range(args.rounds):
            per_round = None if left is None else math.ceil(left / (args.rounds - part))
            last = part == args.rounds - 1
            out = f"{model_root}/step={epoch}" if last else f"{root}/rounds/step=r{rounds}"
            res = run_round(state, blocked, keys, part, n_blocks, out, per_round,
                            order_seed=args.seed * 1000003 + epoch * 7919 + part)
            state = res.state
            rounds += 1
            left = None if left is None else left - res.n_batches
            before, batches = batches, batches + res.n_batches
            log_metrics(spark, root, run_id, "train", rounds,
                        {"train_loss": res.loss, "train_avg_loss_compat": res.avg_loss_compat,
                         "train_rows": res.n_rows, "train_batches": res.n_batches})
            # whenever the running count of mini-batches has passed a multiple, also before the epoch's own
            if args.validation_freq and batches // args.validation_freq > before // args.validation_freq:
                log_metrics(spark, root, run_id, "val_step", rounds,
                            _named("val", evaluate(state, val, "val", args.limit_val_batches)))
        log_metrics(spark, root, run_id, "epoch", epoch,
                    _named("val", evaluate(state, val, "val", args.limit_val_batches)))
    log_metrics(spark, root, run_id, "test", None, _named("test", evaluate(state, test, "test",
                                                                           args.limit_test_batches)))
    return state, read_metrics(spark, root).where(F.col("run_id") == run_id)


def _named(prefix: str, d: dict) -> dict:
    return {f"{prefix}_loss": d["avg_loss_compat"], f"{prefix}_mean_bce": d["mean_bce"], f"{prefix}_auroc": d["auroc"],
            f"{prefix}_rows": d["n_rows"]}
