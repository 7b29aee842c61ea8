"""Ratings sources and the write-once table sink.

The reference reads its CSV with pandas on the driver and ships the rows to
Spark. Here every read is a distributed Spark scan with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType(), True),
    T.StructField("movieId", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
])


def read_ratings_csv(spark: SparkSession, path: str, schema: T.StructType = RATINGS_SCHEMA,
                     mode: str = "PERMISSIVE", corrupt_col: str | None = None) -> DataFrame:
    """Distributed CSV scan with header and a declared schema.

    ``mode`` is Spark's: PERMISSIVE keeps malformed rows with nulls (and the raw
    line in ``corrupt_col`` if given), DROPMALFORMED drops them, FAILFAST raises.
    Columns are found by name in the header, in any order; other columns are read past, and a declared column that
    the header lacks raises an error.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    header = reader.csv(path).columns      # reads the first line only
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"columns missing in the header of {path}: {missing}")
    types = {f.name: f.dataType for f in schema.fields}
    full = [T.StructField(name, types.get(name, T.StringType()), True) for name in header]
    names = [f.name for f in schema.fields]
    if corrupt_col:
        full.append(T.StructField(corrupt_col, T.StringType(), True))
        names.append(corrupt_col)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(T.StructType(full)).csv(path).select(*names)


def write_table_once(df: DataFrame, name: str, path: str | None = None) -> bool:
    """Create the table from ``df`` unless it already exists (``mode("ignore")``).

    Returns True when this call wrote the data.
    """
    spark = df.sparkSession
    existed = spark.catalog.tableExists(name)
    writer = df.write.mode("ignore")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return not existed


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: catalog table scan."""
    return spark.table(name)


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def proxy_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings built from the driver tables (see FIXTURES.md).

    ``lineitem ⋈ orders ⋈ customer`` projected to ``userId = c_name`` (a string
    id like the reference's hashes), ``movieId = l_partkey``,
    ``rating = l_quantity / 10``. Plain inner equi-joins: Catalyst prunes the
    scans to the used columns and AQE picks broadcast or sort-merge from the
    measured sizes.
    """
    li = read_parquet_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = read_parquet_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(cu, od.o_custkey == cu.c_custkey)
            .select(F.col("c_name").alias("userId"),
                    F.col("l_partkey").alias("movieId"),
                    (F.col("l_quantity") / F.lit(10.0)).alias("rating")))


PROXY_RATINGS_SQL = """
SELECT c.c_name AS userId, l.l_partkey AS movieId, l.l_quantity / 10.0 AS rating
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
"""


def current_user(spark: SparkSession) -> DataFrame:
    """The session user as a one-row frame."""
    return spark.range(1).select(F.current_user().alias("current_user"))
