"""The join for heavy keys: same rows as a plain left join, and even tasks."""

import pytest
from pyspark.sql import functions as F

from duotower.operators.index import apply_index, fit_index
from duotower.operators.lookup import embedding_lookup
from duotower.operators.skew import heavy_keys, skew_left_join


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows of one key, a fifth null, the rest over 2,000 keys, some without a table row."""
    k = F.when(F.col("id") % 3 == 0, F.lit("u7")).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), F.col("id") % 2000))
    return spark.range(30_000).select(k.alias("user"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1500).select(F.concat(F.lit("u"), "id").alias("key"), (F.col("id") * 2).alias("value"))


def test_heavy_keys(spark, rows):
    assert heavy_keys(rows, "user", 0.01) == ["u7"] and heavy_keys(rows, "user", 0.9) == [] and heavy_keys(rows.limit(0), "user") == []
    with pytest.raises(ValueError):
        heavy_keys(rows, "user", 0)


@pytest.mark.parametrize("share", [0.01, 0.9])
def test_equals_a_plain_left_join(rows, table, share):
    got = skew_left_join(rows, "user", table, "key", "found", share).select("user", "n", F.col("found.value").alias("value"))
    want = rows.join(table, rows["user"] == table["key"], "left").select("user", "n", "value")
    assert got.count() == 30_000 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_no_task_has_more_than_its_part(spark, rows, table):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = skew_left_join(rows, "user", table, "key", "found", 0.01)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = [r["count"] for r in rows.join(table, rows["user"] == table["key"], "left").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(sizes) <= 1.5 * sorted(sizes)[len(sizes) // 2] and max(plain) > 3 * sorted(plain)[len(plain) // 2]


def test_index_and_lookup_with_heavy_ids(spark, rows):
    model = fit_index(rows.where("n % 4 = 1"), "user", 4)
    for how in ("keep", "skip"):
        plain, heavy = (apply_index(rows, model, handle_invalid=how, heavy_share=s).select("user", "n") for s in (None, 0.05))
        assert plain.exceptAll(heavy).count() == 0 == heavy.exceptAll(plain).count()
    with pytest.raises(Exception, match="unseen or null"):
        apply_index(rows, model, heavy_share=0.05).collect()
    vectors = spark.range(1500).select(F.col("id").alias("bucket"), F.array(F.col("id") * 1.0, F.lit(0.5)).alias("vec"))
    ids = rows.select("n", F.substring("user", 2, 9).cast("long").alias("b"))
    plain, heavy = (embedding_lookup(ids, "b", vectors, "v", 2, heavy_share=s) for s in (None, 0.05))
    assert plain.exceptAll(heavy).count() == 0 == heavy.exceptAll(plain).count()
