"""Dense id -> index, most frequent first.

The reference uses ``StringIndexer``, whose fitted labels live in driver memory
and are shipped to every task. That caps the number of distinct ids at what a
driver can hold. ``fit_index`` keeps the id -> index table as a DataFrame:

    groupBy(id).count  ->  global_row_index(order by count desc, id asc)

and ``apply_index`` is an equi-join, so the table can be as large as the data.
The numbering equals StringIndexer's ``frequencyDesc`` order (ties by id).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.functions.ranking import global_row_index
from duotower.operators.skew import skew_left_join


@dataclass
class IndexModel:
    table: DataFrame  # (<col>, index, freq)
    col: str

    def size(self):
        """Number of labels as a lazy scalar column."""
        return self.table.agg(F.count(F.lit(1))).scalar()

    def next_index(self):
        """The number after the last one as a lazy scalar column (0 for an empty index)."""
        return self.table.agg(F.coalesce(F.max("index") + 1, F.lit(0).cast("long"))).scalar()


def fit_index(df: DataFrame, col: str, n_partitions: int) -> IndexModel:
    """Index 0 for the most frequent id, ties by id ascending. Nulls get no index."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("freq"))
    table = global_row_index(counts, [F.desc("freq"), F.asc(col)], n_partitions, out="index")
    return IndexModel(table.select(col, "index", "freq"), col)


def grow_index(model: IndexModel, df: DataFrame, n_partitions: int) -> IndexModel:
    """W1 over a further batch: ids already numbered keep their number, new ones follow after the last.

    New ids are ordered like ``fit_index`` (most frequent in this batch first, ties by id); ``freq`` becomes the count over
    all batches. The batch is counted per id before it meets the table, so a hot id is one row in the joins, and
    nothing is numbered again: table rows trained under an old number stay valid (see ``model_store.grow_model``).
    """
    col = model.col
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    old = (model.table.join(counts, col, "left")
           .select(col, "index", (F.col("freq") + F.coalesce("_n", F.lit(0))).alias("freq")))
    fresh = number_new(model, counts, "_n", n_partitions)
    return IndexModel(old.unionByName(fresh.select(col, "index", F.col("_n").alias("freq"))), col)


def number_new(model: IndexModel, counts: DataFrame, count_col: str, n_partitions: int) -> DataFrame:
    """The rows of ``counts`` (one per id) whose id ``model`` does not have, with ``index`` after the model's last number."""
    fresh = counts.join(model.table.select(model.col), model.col, "left_anti")
    numbered = global_row_index(fresh, [F.desc(count_col), F.asc(model.col)], n_partitions, out="index")
    return numbered.withColumn("index", F.col("index") + model.next_index())


def apply_index(df: DataFrame, model: IndexModel, handle_invalid: str = "error", out: str | None = None,
                heavy_share: float | None = None) -> DataFrame:
    """W2 + P2 + P3: replace ``col`` by its long index.

    ``handle_invalid``: ``error`` raises on an unseen or null id, ``skip`` drops
    such rows, ``keep`` gives them index = number of labels. With ``heavy_share``, ids above that share of the rows are
    joined apart (see ``skew.py``); without it, hot ids are left to AQE.
    """
    col = model.col
    out = out or col
    lookup = model.table.select(F.col(col).alias("_key"), F.col("index").alias("_idx"))
    if heavy_share is not None:
        found = skew_left_join(df, col, lookup, "_key", "_found", heavy_share).withColumn("_idx", F.col("_found._idx")).drop("_found")
    if handle_invalid == "skip":
        joined = found.where(F.col("_idx").isNotNull()) if heavy_share is not None else df.join(lookup, df[col] == lookup["_key"], "inner")
        idx = F.col("_idx")
    elif handle_invalid in ("keep", "error"):
        joined = found if heavy_share is not None else df.join(lookup, df[col] == lookup["_key"], "left")
        if handle_invalid == "keep":
            idx = F.coalesce(F.col("_idx"), model.size())
        else:
            idx = F.when(F.col("_idx").isNull(),
                         F.raise_error(F.concat(F.lit(f"unseen or null value in {col}: "),
                                                F.coalesce(F.col(col).cast("string"), F.lit("NULL")))))
            idx = F.coalesce(F.col("_idx"), idx.cast("long"))
    else:
        raise ValueError("handle_invalid must be error, skip or keep")
    return joined.withColumn(out, idx.cast("long")).drop("_key", "_idx")
