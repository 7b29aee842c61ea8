"""Snapshots of input-sized results as Parquet in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duotower.session import new_run_id, scratch_path


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: one computation for all later readers, cut lineage, and, unlike a
    checkpoint, compressed columns with pruning and statistics. The files stay until the scratch folder is cleared."""
    spark = df.sparkSession
    path = scratch_path(spark, "snapshots", name, new_run_id())
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
