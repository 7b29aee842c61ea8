"""A growing index as a table of versions (W1, W2): a batch adds its new ids, and old numbers never move.

A version is a folder ``<root>/version=<k>/`` with
  ids/      (<col>, index)   ids first seen in this batch, numbered after all earlier ones
  counts/   (<col>, n)       how often every id of this batch occurs
  meta/     one row: batch, col, first index, number of new ids; written last, as the commit mark

What is written grows with the batch, not with the index. A version whose writing was cut off has no mark; it is not
read, and the next append writes it anew. A batch with a name that a version already has is not appended again, so a
retried batch counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.operators.index import IndexModel, number_new
from duotower.sources.model_store import _delete, _fs

META_SCHEMA = "batch string, col string, first long, n_new long"


def list_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    root = root.rstrip("/")
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names
                  if n.startswith("version=") and fs.exists(_fs(spark, f"{root}/{n}/meta/_SUCCESS")[1]))


def _read(spark: SparkSession, root: str, versions: list[int], part: str) -> DataFrame:
    frames = [spark.read.parquet(f"{root.rstrip('/')}/version={k}/{part}").withColumn("version", F.lit(k)) for k in versions]
    return reduce(DataFrame.unionByName, frames)


def index_meta(spark: SparkSession, root: str) -> DataFrame:
    """(version, batch, col, first, n_new) of every complete version."""
    versions = list_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], f"{META_SCHEMA}, version int")
    return _read(spark, root, versions, "meta")


def load_index(spark: SparkSession, root: str, version: int | None = None) -> IndexModel:
    """The index as of ``version`` (the last one if not given); its table has ``version``, that of each id's first sight, too."""
    versions = [k for k in list_versions(spark, root) if version is None or k <= version]
    if not versions or (version is not None and versions[-1] != version):
        raise ValueError(f"no complete version {'' if version is None else version} under {root}")
    col = index_meta(spark, root).where(F.col("version") == versions[-1]).first()["col"]
    freq = _read(spark, root, versions, "counts").groupBy(col).agg(F.sum("n").alias("freq"))
    return IndexModel(_read(spark, root, versions, "ids").join(freq, col).select(col, "index", "freq", "version"), col)


def append_version(df: DataFrame, col: str, root: str, n_partitions: int, batch: str) -> int:
    """Add the batch ``df`` to the index under ``root`` and return its version number.

    The first batch gives the numbering of ``fit_index``. Null ids get no number. An empty batch makes a version without
    new ids. If ``batch`` names a version that is there already, nothing is written and its number is returned. One
    writer at a time.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if col in ("index", "n", "freq", "version"):
        raise ValueError(f"the index tables use the name {col} themselves")
    versions = list_versions(spark, root)
    done = {r["batch"]: r for r in index_meta(spark, root).collect()}      # one row per version
    if any(r["col"] != col for r in done.values()):
        raise ValueError(f"the index under {root} is not one of {col}")
    if batch in done:
        return done[batch]["version"]
    version = versions[-1] + 1 if versions else 0
    path = f"{root}/version={version}"
    _delete(spark, path)            # what an append that was cut off left behind
    (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
     .write.parquet(f"{path}/counts"))
    counts = spark.read.parquet(f"{path}/counts")
    if versions:
        known = IndexModel(_read(spark, root, versions, "ids"), col)
    else:
        known = IndexModel(counts.limit(0).select(col, F.lit(0).cast("long").alias("index")), col)
    number_new(known, counts, "n", n_partitions).select(col, "index").write.parquet(f"{path}/ids")
    first = sum(r["n_new"] for r in done.values())
    n_new = spark.read.parquet(f"{path}/ids").count()
    spark.createDataFrame([(batch, col, first, n_new)], META_SCHEMA).coalesce(1).write.parquet(f"{path}/meta")
    return version
