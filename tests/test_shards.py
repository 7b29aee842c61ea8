"""The sharded data source: round trips, one partition per entry, pruning, commit."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duotower.sources.shards import grouped, index_frame, may_hold, read_dataset, read_index, register

ROWS = "label int, userId long, movieId long, name string, vec array<double>, split string"


def table(spark, n=500, start=0):
    rows = [(k % 2 if k % 7 else None, k, None if k % 11 == 0 else k * 3, f"é{k}" if k % 5 else None, [float(k), 0.5] if k % 3 else None,
             ("train", "train", "train", "test", None)[k % 5]) for k in range(start, start + n)]
    return spark.createDataFrame(rows, ROWS)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.fixture(scope="module")
def source(spark):
    register(spark)
    return spark


def test_round_trip_with_an_entry_per_partition(source, tmp_path):
    path, df = str(tmp_path / "a"), table(source).repartition(3)
    df.write.format("shards").mode("append").option("rows_per_shard", 40).save(path)
    back = source.read.format("shards").load(path)
    assert back.schema == df.schema and same(back, df)
    entries = read_index(path)["shards"]
    assert sum(e["rows"] for e in entries) == 500 and max(e["rows"] for e in entries) == 40 and {e["split"] for e in entries} == {"train", "test", None}
    assert back.rdd.getNumPartitions() == len(entries)
    assert index_frame(source, path).groupBy("split").agg(F.sum("rows").alias("n")).where("split = 'train'").first().n == 300
    assert all(os.path.getsize(os.path.join(path, e["file"])) == e["bytes"] for e in entries)


def test_many_small_shards_share_partitions(source, tmp_path):
    """A task for every small shard makes the tasks grow with the rows, at any size of a task."""
    path, df = str(tmp_path / "many"), table(source).repartition(3)
    df.write.format("shards").mode("append").option("rows_per_shard", 1).save(path)
    back = source.read.format("shards").load(path)
    assert len(read_index(path)["shards"]) == 500 and back.rdd.getNumPartitions() <= 2 * 200 < 500
    assert same(back, df)
    sizes = [{"bytes": b, "file": k} for k, b in enumerate([10, 1 << 30, 20, 30] * 100)]
    groups = grouped(sizes)
    assert [s for g in groups for s in g] == sizes and all(len(g) == 1 or sum(s["bytes"] for s in g) <= 64 << 20 for g in groups)


def test_pruning_of_splits_columns_and_ranges(source, tmp_path):
    path = str(tmp_path / "b")
    table(source).repartitionByRange(4, "userId").write.format("shards").mode("append").save(path)
    full = source.read.format("shards").load(path)
    for condition in ("split = 'test'", "split IS NULL", "userId > 480", "userId <= 3 OR split = 'test'", "length(name) > 3"):
        assert same(full.where(condition), table(source).where(condition)), condition       # one DataFrame, several filters
    for splits, between, condition in ((["test"], {}, "split = 'test'"), (["test", None], {}, "split = 'test' OR split IS NULL"), ([], {}, "false"),
                                       (None, {"userId": (481, None)}, "userId >= 481"), (["train"], {"userId": (None, 17)}, "split = 'train' AND userId <= 17"),
                                       (None, {"movieId": (30, 90), "label": (1, 1)}, "movieId BETWEEN 30 AND 90 AND label = 1")):
        assert same(read_dataset(source, path, splits, None, between), table(source).where(condition)), condition
    parts = full.rdd.getNumPartitions()
    assert read_dataset(source, path, ["test"]).rdd.getNumPartitions() == sum(e["split"] == "test" for e in read_index(path)["shards"]) < parts
    assert read_dataset(source, path, between={"userId": (481, None)}).rdd.getNumPartitions() < parts
    assert same(read_dataset(source, path, columns=["name"], between={"userId": (3, 9)}), table(source).where("userId BETWEEN 3 AND 9").select("name"))
    narrow = source.read.format("shards").option("columns", "movieId, split").load(path)
    assert narrow.columns == ["movieId", "split"] and same(narrow, table(source).select("movieId", "split"))
    assert same(source.read.format("shards").schema("userId long").load(path), table(source).select("userId"))


def test_append_overwrite_and_failed_writes(source, tmp_path):
    path = str(tmp_path / "c")
    table(source, 50).write.format("shards").mode("append").save(path)
    table(source, 30, 100).write.format("shards").mode("append").save(path)
    assert same(source.read.format("shards").load(path), table(source, 50).union(table(source, 30, 100)))
    failing = F.udf(lambda k: 1 // (k - 45), "long")
    with pytest.raises(Exception):
        table(source, 50).withColumn("userId", failing("userId")).write.format("shards").mode("append").save(path)
    with pytest.raises(Exception, match="schema"):
        table(source, 5).drop("vec").write.format("shards").mode("append").save(path)
    assert source.read.format("shards").load(path).count() == 80        # a failed write is not seen
    table(source, 20).write.format("shards").mode("overwrite").save(path)
    assert same(source.read.format("shards").load(path), table(source, 20))
    with pytest.raises(Exception, match="index.json"):
        source.read.format("shards").load(str(tmp_path / "nothing")).count()


def test_empty_tables_and_tables_without_splits(source, tmp_path):
    path = str(tmp_path / "d")
    table(source, 0).write.format("shards").mode("append").save(path)
    assert source.read.format("shards").load(path).count() == 0
    plain = source.range(10).withColumn("x", F.col("id") * 2)
    plain.write.format("shards").mode("overwrite").save(path)
    assert same(source.read.format("shards").load(path), plain)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1), st.none() | st.integers(-6, 6), st.none() | st.integers(-6, 6))
def test_ranges_never_prune_a_matching_shard(values, low, high):
    matches = any((low is None or v >= low) and (high is None or v <= high) for v in values)
    assert may_hold([min(values), max(values)], low, high) or not matches
    assert not may_hold(None, low, high)
