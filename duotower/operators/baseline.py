"""Baseline ranker (R3): factorisation machine on one-hot user and item.

A model with the same inputs as the two towers and no MLPs, trained with
Spark ML's ``FMClassifier``, to put the two-tower numbers in context.

The one-hot vectors are made as rows: Spark ML's ``OneHotEncoder`` and ``VectorAssembler`` describe every category as an
object in the column's metadata, on the driver and again in every plan, which for ids is more than the model itself.

Spark ML keeps about ten copies of the coefficients on the driver. A model of more than ``DRIVER_BYTES`` is trained by the same
steps over slices of it (``fm_tables.py``), and scored by lookups.
"""

from __future__ import annotations

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duotower.operators.fm_tables import FMTables, fit_tables
from duotower.snapshot import snapshot

ID_COLS = ("userId", "movieId")
DRIVER_BYTES = 16 << 20     # of coefficients that Spark ML may train


def one_hot_sizes(train: DataFrame) -> list[int]:
    """Categories per id column: user ids are already dense indexes and item ids are non-negative integers, so they are
    the one-hot indexes directly (no label table on the driver)."""
    return [int(n) for n in train.agg(*[F.coalesce(F.max(c), F.lit(-1)) + 1 for c in ID_COLS]).first()]


def checked_id(c: str) -> F.Column:
    """The id; a null or negative one is an error."""
    bad = F.raise_error(F.concat(F.lit(f"{c} is null or negative: "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
    return F.when(F.col(c).isNull() | (F.col(c) < 0), bad.cast("long")).otherwise(F.col(c).cast("long"))


def one_hot(df: DataFrame, sizes: list[int]) -> DataFrame:
    """(label double, features): the sparse vector with ones at the user and, behind the users, at the item; an id past
    the sizes (not seen in training) adds none. A null or negative id is an error."""
    ones, before = [], 0
    for c, size in zip(ID_COLS, sizes):
        bad = F.raise_error(F.concat(F.lit(f"{c} is null or negative: "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
        ones.append(F.when(F.col(c).isNull() | (F.col(c) < 0), bad.cast("long")).when(F.col(c) < size, F.col(c) + before))
        before += size
    at = F.array_compact(F.array(*ones))
    vector = F.struct(F.lit(0).alias("type"), F.lit(before).alias("size"), at.alias("indices"), F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    parsed = F.from_json(F.to_json(F.struct(vector.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))
    return df.select(F.col("label").cast("double"), parsed["v"].alias("features"))


def fit_fm(train: DataFrame, factor_size: int = 8, max_iter: int = 20, step_size: float = 0.05,
           seed: int = 42, driver_bytes: int = DRIVER_BYTES) -> tuple[FMClassificationModel | FMTables, list[int]]:
    """The model and the one-hot sizes."""
    train = train.where(F.col("label").isNotNull())
    sizes = one_hot_sizes(train)
    if min(sizes) > 0 and sum(sizes) * (factor_size + 1) * 8 > driver_bytes:
        rows = snapshot(train.select(*[checked_id(c).alias(name) for c, name in zip(ID_COLS, "ui")], F.col("label").alias("y")), "fm_rows")
        return fit_tables(rows, sizes, factor_size, max_iter, step_size, seed), sizes
    fm = FMClassifier(labelCol="label", featuresCol="features", factorSize=factor_size, maxIter=max_iter,
                      stepSize=step_size, seed=seed)
    return fm.fit(one_hot(train, sizes)), sizes


def score_fm(model: tuple[FMClassificationModel | FMTables, list[int]], df: DataFrame) -> DataFrame:
    fm, sizes = model
    if isinstance(fm, FMTables):
        rows = df.where(F.col("label").isNotNull()).select(F.col("label").cast("int").alias("label"), *[checked_id(c).alias(c) for c in ID_COLS])
        return fm.raw(rows, ID_COLS).select("label", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("raw")))).alias("prob"))
    out = fm.transform(one_hot(df.where(F.col("label").isNotNull()), sizes))
    return out.select(F.col("label").cast("int").alias("label"),
                      vector_to_array(F.col("probability")).getItem(1).alias("prob"))
