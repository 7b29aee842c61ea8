"""A left join that survives heavy keys (J1, W2): no task gets more than its part of the rows.

Keys with more than ``share`` of the rows are found by an approximate top-k aggregate (a bounded sketch per task, merged), so
there are at most ``1 / share`` of them. Their table rows are broadcast: at most that many rows, whatever the table's size.
All other rows meet the table in one ordinary join; there, rows with a heavy or null key stand under spread-out salts that match
nothing, so they are dealt evenly. Every row is read and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def heavy_keys(df: DataFrame, key: str, share: float = 0.005) -> list:
    """Keys that (about) more than ``share`` of the rows have; never null. At most ``1 / share`` of them reach the driver."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    most = max(1, int(1 / share))
    known = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    row = known.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(10_000, 20 * most)})").alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] > share * row["n"]]


def skew_left_join(df: DataFrame, key: str, table: DataFrame, table_key: str, out: str, share: float = 0.005) -> DataFrame:
    """``df`` with ``out`` = struct of the other columns of the row of ``table`` whose ``table_key`` equals ``key`` (null without one).

    ``table_key`` must be unique, and keys must differ as text (numbers and strings do).
    """
    heavy = heavy_keys(df, key, share)
    names = [c for c in table.columns if c != table_key]
    t = table.select(F.col(table_key).alias("_tk"), F.struct(*names).alias("_tv"))
    is_heavy = F.col("_lk").isin(heavy) if heavy else F.lit(False)
    spread = F.coalesce(F.col("_lk").isNull() | is_heavy, F.lit(True))
    rows = df.withColumn("_lk", F.col(key))
    # one text key for both cases: a constant salt beside the key would be folded away and all spread rows meet in one task
    salt = F.concat(F.lit("*"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    rows = rows.withColumn("_jk", F.when(spread, salt).otherwise(F.concat(F.lit("="), F.col("_lk").cast("string"))))
    joined = rows.join(t.withColumn("_jt", F.concat(F.lit("="), F.col("_tk").cast("string"))), F.col("_jk") == F.col("_jt"), "left")
    found = F.col("_tv")
    joined = joined.drop("_tk", "_jt")
    if heavy:
        few = F.broadcast(t.where(F.col("_tk").isin(heavy)).select(F.col("_tk").alias("_hk"), F.col("_tv").alias("_hv")))     # 1 / share rows at most
        joined = joined.join(few, F.col("_lk") == F.col("_hk"), "left")
        found = F.coalesce("_tv", "_hv")
    return joined.withColumn(out, found).drop("_lk", "_jk", "_tv", "_hk", "_hv")
