"""Embedding lookup (J1) and multi-id bag pooling (J2) as equi-joins.

A missing id (NULL bucket) is an empty bag and pools to the zero vector. NULL
keys are not sent to one partition: they get a spread-out negative key that
matches nothing. Hot buckets are left to AQE's skew-join split, never to a
broadcast of a table that grows with the data: Spark counts an array as one
element, so its own estimate of such a table is far too small.

Two lookups per row (``embedding_lookups``) are made in cells, so that rows do not carry the first vector through the
shuffle of the second.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duotower.functions.vectors import to_double_array, zeros
from duotower.operators.buckets import to_bucket
from duotower.operators.skew import skew_left_join
from duotower.session import new_run_id, scratch_path
from duotower.snapshot import snapshot

NULL_SPREAD = 4096
SMALL_TABLE = 16 << 20      # bytes of vectors that may be broadcast, by a count of the rows
BLOCK_BYTES = 96 << 20      # bytes of vectors of one side that a cell holds
CELL_ROWS = 50_000          # rows below which a cell is not cut further
READS_PER_ROW = 2           # vectors read by cells, per row, up to which rows are not joined


def _spread_null_key(df: DataFrame, bucket_col: str) -> F.Column:
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NULL_SPREAD))
    return F.coalesce(F.col(bucket_col), F.lit(-1) - spread)


def embedding_lookup(df: DataFrame, bucket_col: str, table: DataFrame, out: str, dim: int,
                     table_key: str = "bucket", table_vec: str = "vec", heavy_share: float | None = None) -> DataFrame:
    """Attach ``table[bucket_col]`` as ``out`` (array<double>); missing -> zeros(dim).

    With ``heavy_share``, buckets above that share of the rows are joined apart (see ``skew.py``); without it, hot buckets are left to AQE.
    """
    if heavy_share is not None:
        vectors = table.select(F.col(table_key).alias("_key"), to_double_array(F.col(table_vec)).alias("_vec"))
        found = skew_left_join(df, bucket_col, vectors, "_key", "_found", heavy_share)
        return found.withColumn(out, F.coalesce("_found._vec", zeros(dim))).drop("_found")
    t = table.select(F.col(table_key).alias("_tk"), to_double_array(F.col(table_vec)).alias(out))
    left = df.withColumn("_lk", _spread_null_key(df, bucket_col))
    joined = left.join(t.hint("merge"), left["_lk"] == t["_tk"], "left").drop("_lk", "_tk")
    return joined.withColumn(out, F.coalesce(F.col(out), zeros(dim)))


def embedding_lookups(df: DataFrame, sides: list[tuple[str, DataFrame, str]], dim: int, sizes: list[int] | None = None,
                      table_key: str = "bucket", table_vec: str = "vec", small_bytes: int = SMALL_TABLE,
                      block_bytes: int = BLOCK_BYTES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """J1 for two columns at once: ``sides`` are two (bucket column, table, out), with the result of ``embedding_lookup`` on each.

    ``sizes`` are the tables' rows (counted if not given). Tables of at most ``small_bytes`` are broadcast. Otherwise buckets of
    either side are hashed into blocks of about ``block_bytes`` of vectors, written once to the shared scratch folder. A row
    belongs to the cell of its two blocks: only narrow rows are shuffled, and a cell's task reads its two blocks. Cells with
    many rows are cut (their blocks are read again), so a hot bucket is dealt over several tasks. If the vectors read were
    more than ``READS_PER_ROW`` times the rows, each row meets its vectors by two joins.
    """
    sizes = sizes or [table.count() for _, table, _ in sides]
    width = dim * 8 + 8
    if max(sizes) * width <= small_bytes:
        return _two_joins(df, sides, dim, table_key, table_vec, "broadcast")
    counts = [max(1, math.ceil(n * width / block_bytes)) for n in sizes]
    rows, cells, total = cell_plan(df, [col for col, *_ in sides], counts, cell_rows)
    copies = sum(cut * (sizes[0] / counts[0] + sizes[1] / counts[1]) for *_, cut in cells)
    if not cells or copies > READS_PER_ROW * total:
        return _two_joins(rows.drop("_b0", "_b1"), sides, dim, table_key, table_vec, "merge")
    homes = {cell: (b0, b1) for b0, b1, first, cuts in cells for cell in range(first, first + cuts)}
    names = df.columns
    written = [written_blocks(table, table_key, table_vec, n) for (_, table, _), n in zip(sides, counts)]
    dealt = dealt_cells(rows, cells)
    outs = [out for *_, out in sides]
    fields = [*df.schema.fields, *[T.StructField(out, T.ArrayType(T.DoubleType())) for out in outs]]
    looked = dealt.mapInArrow(_cell_lookup(names, [col for col, *_ in sides], outs, written, homes), T.StructType(fields))
    return looked.withColumns({out: F.coalesce(F.col(out), zeros(dim)) for out in outs})


def cell_plan(df: DataFrame, cols: list[str], counts: list[int], cell_rows: int = CELL_ROWS):
    """The rows with their blocks, written once, the cells (blocks, first number, cuts) that have rows, and the number of rows.
    ``cols`` are two bucket columns, whose tables have ``counts`` blocks."""
    blocks = [F.pmod(F.xxhash64(_spread_null_key(df, col).cast("long")), F.lit(n)).cast("int").alias(f"_b{k}")
              for k, (col, n) in enumerate(zip(cols, counts))]
    rows = snapshot(df.select("*", *blocks), "lookup_rows")
    found = rows.groupBy("_b0", "_b1").count().collect()        # one row per cell
    total = sum(r["count"] for r in found)
    most = max(cell_rows, math.ceil(1.5 * total / (2 * df.sparkSession.sparkContext.defaultParallelism)))
    cells, n_cells = [], 0
    for r in sorted(found):
        cuts = math.ceil(r["count"] / most)
        cells.append((r["_b0"], r["_b1"], n_cells, cuts))
        n_cells += cuts
    return rows, cells, total


def dealt_cells(rows: DataFrame, cells: list) -> DataFrame:
    """The rows of ``cell_plan`` without their blocks, with ``_cell``; every cell is a partition of its own, so its rows need no sort."""
    plan = rows.sparkSession.createDataFrame(cells, "_b0 int, _b1 int, _first int, _cuts int")
    cut = (F.col("_first") + F.pmod(F.monotonically_increasing_id(), F.col("_cuts"))).cast("int")
    names = [c for c in rows.columns if c not in ("_b0", "_b1")]
    return (rows.join(F.broadcast(plan), ["_b0", "_b1"]).select(*names, cut.alias("_cell"))
            .repartitionById(sum(cuts for *_, cuts in cells), "_cell"))


def written_blocks(table: DataFrame, table_key: str, table_vec: str, n: int) -> str:
    """The table's vectors written once to the shared scratch folder, a folder per block; returns the path."""
    path = scratch_path(table.sparkSession, "lookup_blocks", new_run_id())
    (table.where(F.col(table_key).isNotNull()).select(F.col(table_key).cast("long").alias("_tk"), F.col(table_vec).alias("_vec"))
     .withColumn("_block", F.pmod(F.xxhash64("_tk"), F.lit(n)).cast("int"))
     .write.option("compression", "zstd").partitionBy("_block").parquet(path))
    return path


def _two_joins(df: DataFrame, sides: list, dim: int, table_key: str, table_vec: str, how: str) -> DataFrame:
    for col, table, out in sides:
        t = table.select(F.col(table_key).alias("_tk"), to_double_array(F.col(table_vec)).alias(out))
        left = df.withColumn("_lk", _spread_null_key(df, col))
        df = left.join(t.hint(how), left["_lk"] == t["_tk"], "left").drop("_lk", "_tk")
        df = df.withColumn(out, F.coalesce(F.col(out), zeros(dim)))
    return df


def read_block(path: str, k: int):
    """In a task: sorted ids, their places and the vectors of a block (none, if no id hashes to it)."""
    double = pa.list_(pa.float64())
    if path.startswith("file:") and "://" not in path:
        path = path[len("file:"):]
    fs, base = pafs.FileSystem.from_uri(path)
    folder = fs.get_file_info(f"{base}/_block={k}")
    if folder.type == pafs.FileType.NotFound:
        return np.empty(0, np.int64), np.empty(0, np.int64), pa.array([], double)
    found = ds.dataset(folder.path, schema=pa.schema({"_tk": pa.int64(), "_vec": double}), filesystem=fs, format="parquet").to_table()
    ids = found.column("_tk").to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], order, found.column("_vec").combine_chunks()


def _cell_lookup(names: list[str], cols: list[str], outs: list[str], written: list[str], homes: dict[int, tuple[int, int]]):
    """``mapInArrow`` body: the rows of a cell meet its two blocks of vectors, which are read from the shared folder."""
    def matches(rows: pa.RecordBatch, col: str, ids: np.ndarray):
        """First place among the sorted ids, and how many there are, of every row."""
        bucket = rows.column(col)
        values = bucket.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        first = np.searchsorted(ids, values, "left")
        n = np.searchsorted(ids, values, "right") - first
        return first, np.where(bucket.is_valid().to_numpy(zero_copy_only=False), n, 0)

    def looked_up(rows: pa.RecordBatch, tables: list):
        at, taken = np.arange(rows.num_rows), []
        for col, (ids, order, _) in zip(cols, tables):
            first, n = matches(rows, col, ids)
            first, n = first[at], n[at]
            times = np.maximum(n, 1)        # a row without a match stays once, one with several is repeated
            again = np.repeat(np.arange(len(at)), times)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
            place = np.where(n[again] > 0, first[again] + nth, -1)
            taken = [p[again] for p in taken] + [place]
            at = at[again]
        vecs = [table[2].take(pa.array(table[1][place] if len(table[1]) else place, pa.int64(), mask=place < 0))
                for place, table in zip(taken, tables)]
        same = len(at) == rows.num_rows
        kept = [rows.column(c) if same else rows.column(c).take(pa.array(at)) for c in names]
        return pa.RecordBatch.from_arrays(kept + vecs, names=names + outs)

    def run(batches):
        cell, tables = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            home = batch.column("_cell").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(home)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(home)]):
                if cell != home[lo]:
                    cell, tables = int(home[lo]), None
                    tables = [read_block(path, k) for path, k in zip(written, homes[cell])]
                yield looked_up(batch.slice(int(lo), int(hi - lo)), tables)

    return run


def bag_pooling(bags: DataFrame, key_cols: list[str], id_col: str, table: DataFrame, num_embeddings, dim: int,
                zero_is_missing: bool = True, table_key: str = "bucket", table_vec: str = "vec",
                out: str = "pooled", small_bytes: int = SMALL_TABLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Sum-pool the table rows of every id in a bag.

    ``bags`` is in long form, one row per (bag key, id). A table of at most ``small_bytes`` (by its rows) is joined and its vectors
    are summed by ``dim`` ordinary ``sum`` aggregates, which Spark combines map-side. For a larger one, bags are dealt by
    key to cells that get a copy of the table, and pooled there: narrow rows and the copies are shuffled, no vector per row.
    Cells with several times the usual rows (a hot bag) take the first way, where a bag holding a third of
    all rows is one partial row per task, and so do all if the copies were more than the rows.
    Output: key columns, ``bag_size`` (non-missing ids), ``out``.
    """
    b = bags.select(*key_cols, to_bucket(F.col(id_col), num_embeddings, zero_is_missing).alias("_b"))
    t = table.select(F.col(table_key).alias("_tb"), to_double_array(F.col(table_vec)).alias("_v"))
    size = table.count()
    if size * (dim * 8 + 8) <= small_bytes:
        return _pooled_by_join(b, key_cols, t.hint("broadcast"), dim, out)
    total = b.count()
    n_cells = max(2 * bags.sparkSession.sparkContext.defaultParallelism, math.ceil(total / (20 * cell_rows)))
    rows = b.withColumn("_cell", F.pmod(F.xxhash64(*key_cols), F.lit(n_cells)).cast("int"))
    if n_cells * size > total:
        return _pooled_by_join(b, key_cols, t.hint("merge"), dim, out)
    rows = snapshot(rows, "bag_rows")
    most = max(cell_rows, 4 * total // n_cells)
    hot = [r["_cell"] for r in rows.groupBy("_cell").count().where(F.col("count") > most).collect()]     # n_cells rows at most
    cells = bags.sparkSession.range(n_cells).select(F.col("id").cast("int").alias("_cell")).where(~F.col("_cell").isin(hot))
    vectors = (table.where(F.col(table_key).isNotNull()).select(F.col(table_key).cast("long").alias("_b"), F.col(table_vec).alias("_vec"))
               .crossJoin(F.broadcast(cells)).withColumn("_kind", F.lit(0)))
    cold = rows.where(~F.col("_cell").isin(hot)).withColumn("_kind", F.lit(1)).withColumn("_vec", F.array().cast(table.schema[table_vec].dataType))
    dealt = (vectors.unionByName(cold, allowMissingColumns=True).repartitionById(n_cells, "_cell")
             .sortWithinPartitions("_cell", "_kind", *key_cols).select("_cell", "_kind", "_b", "_vec", *key_cols))
    fields = [bags.schema[c] for c in key_cols] + [T.StructField("bag_size", T.LongType()), T.StructField(out, T.ArrayType(T.DoubleType()))]
    pooled = dealt.mapInArrow(_cell_pooling(key_cols, dim, out), T.StructType(fields))
    if not hot:
        return pooled
    return pooled.unionByName(_pooled_by_join(rows.where(F.col("_cell").isin(hot)).drop("_cell"), key_cols, t.hint("merge"), dim, out))


def _pooled_by_join(b: DataFrame, key_cols: list[str], t: DataFrame, dim: int, out: str) -> DataFrame:
    left = b.withColumn("_lk", _spread_null_key(b, "_b"))
    joined = left.join(t, left["_lk"] == t["_tb"], "left")
    sums = [F.sum(F.col("_v")[j]).alias(f"_s{j}") for j in range(dim)]
    agg = joined.groupBy(*key_cols).agg(F.count("_b").alias("bag_size"), *sums)
    pooled = F.array(*[F.coalesce(F.col(f"_s{j}"), F.lit(0.0)) for j in range(dim)])
    return agg.select(*key_cols, "bag_size", pooled.alias(out))


def _cell_pooling(key_cols: list[str], dim: int, out: str):
    """``mapInArrow`` body: per cell first the table (``_kind`` 0), then its rows in the order of their bags."""

    def matrix(parts: list):
        """Sorted ids and their vectors; null vectors and entries add nothing."""
        ids = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
        mat = np.zeros((len(ids), dim))
        at = 0
        for _, vecs in parts:
            known = np.flatnonzero(vecs.is_valid().to_numpy(zero_copy_only=False))
            mat[at + known] = vecs.flatten().cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(known), dim)
            at += len(vecs)
        order = np.argsort(ids, kind="stable")
        return ids[order], order, mat

    def starts(rows: pa.RecordBatch) -> np.ndarray:
        """Where a new bag begins."""
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for c in key_cols:
            codes = rows.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= np.diff(codes) != 0
        return np.flatnonzero(new)

    def pooled(rows: pa.RecordBatch, table) -> pa.RecordBatch:
        ids, order, mat = table
        bucket = rows.column("_b")
        valid = bucket.is_valid().to_numpy(zero_copy_only=False)
        values = bucket.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        first = np.searchsorted(ids, values, "left")
        n = np.where(valid, np.searchsorted(ids, values, "right") - first, 0)
        begin = starts(rows)
        bag = np.cumsum(np.bincount(begin, minlength=rows.num_rows)) - 1
        # a missing id adds no row, an id that the table does not have counts, one that it has twice counts and adds twice
        counted = np.bincount(bag, weights=np.where(valid, np.maximum(n, 1), 0), minlength=len(begin)).astype(np.int64)
        sums = np.zeros((len(begin), dim))
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(first, n) + nth
        if len(at):
            owner = np.repeat(bag, n)
            cut = np.flatnonzero(np.r_[True, np.diff(owner) != 0])
            sums[owner[cut]] = np.add.reduceat(mat[order[at]], cut, axis=0)
        offsets = pa.array(np.arange(0, (len(begin) + 1) * dim, dim, dtype=np.int32))
        keys = [rows.column(c).take(pa.array(begin)) for c in key_cols]
        return pa.RecordBatch.from_arrays([*keys, pa.array(counted), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))],
                                          names=[*key_cols, "bag_size", out])

    def run(batches):
        cell, parts, table, held = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            home = batch.column("_cell").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(home)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(home)]):
                if cell != home[lo]:
                    if held is not None:
                        yield pooled(held, table)
                    cell, parts, table, held = home[lo], [], None, None
                part = batch.slice(int(lo), int(hi - lo))
                end = int(np.searchsorted(part.column("_kind").to_numpy(zero_copy_only=False), 1))
                if end:
                    some = part.slice(0, end)
                    parts.append((some.column("_b").to_numpy(zero_copy_only=False), some.column("_vec")))
                rows = part.slice(end).select(["_b", *key_cols])
                if not rows.num_rows:
                    continue
                if table is None:
                    table, parts = matrix(parts), []
                rows = rows if held is None else pa.concat_batches([held, rows])
                last = int(starts(rows)[-1])        # the last bag may go on in the next batch
                if last:
                    yield pooled(rows.slice(0, last), table)
                held = rows.slice(last)
        if held is not None:
            yield pooled(held, table)

    return run
