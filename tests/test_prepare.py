"""Prepare-stage operators: label, distinct counts, index, split, sort/limit, batches, buckets."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from duotower.functions.ranking import global_row_index
from duotower.operators.buckets import bucket_collisions, sparse_features, to_bucket
from duotower.operators.index import apply_index, fit_index
from duotower.operators.label import binarize_at_mean
from duotower.operators.profile import distinct_with_null, profile_counts
from duotower.operators.sort import sorted_head
from duotower.operators.split import hash_split
from duotower.streaming.batches import assign_batches, chunk_batches, limit_batches

RS = "userId string, movieId long, rating double"


def test_label_ties_null_nan(spark):
    # mean of valid ratings = (1 + 2 + 3) / 3 = 2; NaN and null excluded from the mean and labelled null
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0), ("c", 3, 3.0), ("d", 4, None),
                                ("e", 5, float("nan"))], RS)
    out = {r.userId: r.label for r in binarize_at_mean(df).collect()}
    assert out == {"a": 0, "b": 1, "c": 1, "d": None, "e": None}


def test_distinct_counts_null(spark):
    df = spark.createDataFrame([("a", 1, 1.0), (None, 1, 2.0)], RS)
    p = profile_counts(df).first()
    d = distinct_with_null(df).first()
    assert p.n_users == 1 and d.user_count == 2 and d.movie_count == 1
    assert p.n_null_user == 1 and p.n_rows == 2


def _ratings(spark):
    rows = []
    for u, n in [("u3", 3), ("u1", 3), ("u2", 5), ("u0", 1), ("u9", 3)]:
        rows += [(u, i, 1.0) for i in range(n)]
    return spark.createDataFrame(rows, RS)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_index_matches_stringindexer(spark, parts):
    df = _ratings(spark)
    ours = {r.userId: r["index"] for r in fit_index(df, "userId", parts).table.collect()}
    # frequency desc, then id asc
    assert ours == {"u2": 0, "u1": 1, "u3": 2, "u9": 3, "u0": 4}
    from pyspark.ml.feature import StringIndexer

    ml = StringIndexer(inputCol="userId", outputCol="ix").fit(df).transform(df).select("userId", "ix").distinct()
    assert {r.userId: int(r.ix) for r in ml.collect()} == ours


def test_global_row_index_equals_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1013).alias("a"), F.col("id").alias("b"))
    ours = global_row_index(df, [F.desc("a"), F.asc("b")], 9).select("b", "index")
    w = Window.orderBy(F.desc("a"), F.asc("b"))
    ref = df.select("b", (F.row_number().over(w) - 1).alias("index"))
    assert ours.exceptAll(ref).count() == 0 and ours.count() == 5000


def test_apply_index_invalid(spark):
    df = _ratings(spark)
    model = fit_index(df.where(F.col("userId") != "u0"), "userId", 2)
    keep = apply_index(df, model, "keep").where(F.col("movieId") == 0).collect()
    assert sorted(r.userId for r in keep) == [0, 1, 2, 3, 4]   # u0 unseen -> 4 labels -> index 4
    assert apply_index(df, model, "skip").count() == df.count() - 1
    with pytest.raises(Exception):
        apply_index(df, model, "error").collect()


def test_hash_split_disjoint_complete_stable(spark):
    rows = [(f"u{i % 97}", i % 131, 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, RS)
    a = hash_split(df.repartition(1), ["userId", "movieId"])
    b = hash_split(df.repartition(11), ["userId", "movieId"])
    assert a.exceptAll(b).count() == 0
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 4000 and set(counts) == {"train", "validation", "test"}
    assert abs(counts["train"] / 4000 - 0.7) < 0.05
    # repeated pairs share one split
    assert a.groupBy("userId", "movieId").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0


def test_sorted_head(spark):
    rows = [("u%d" % (i % 5), i % 3, float(i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, RS)
    head = sorted_head(df, 37, ["userId", "movieId"], 3)
    assert sorted(tuple(r) for r in head.collect()) == sorted(rows)[:37]
    assert sorted_head(df, 10_000, ["userId", "movieId"], 3).count() == 200


def test_distinct_with_null_of_no_rows(spark):
    from duotower.operators.profile import distinct_with_null

    assert tuple(distinct_with_null(spark.createDataFrame([], RS)).first()) == (0, 0)


def test_batches(spark):
    df = spark.range(2049).select(F.col("id").alias("rid"))
    b = assign_batches(df, ["rid"], 1024, n_shards=1)
    sizes = sorted(r["count"] for r in b.groupBy("batch_seq").count().collect())
    assert sizes == [1, 1024, 1024]
    b2 = assign_batches(df.repartition(5), ["rid"], 1024, n_shards=1)
    assert b.exceptAll(b2).count() == 0
    assert limit_batches(b, 2).count() == 2048
    assert chunk_batches(b, 2).select("chunk_id").distinct().count() == 2
    with pytest.raises(ValueError):
        chunk_batches(b, 0)


def test_buckets_rule(spark):
    n = 5
    ids = [0, 1, n - 1, n, n + 1, -3, None]
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    got = [r.b for r in df.select(to_bucket(F.col("x"), n).alias("b")).collect()]
    assert got == [None, 1, 4, 0, 1, 2, None]
    got2 = [r.b for r in df.select(to_bucket(F.col("x"), n, zero_is_missing=False).alias("b")).collect()]
    assert got2[0] == 0
    col = bucket_collisions(df, "x", n).collect()
    assert {(r.bucket, r.n_ids) for r in col} == {(1, 2)}
    sf = sparse_features(df.withColumn("y", F.col("x")), ["x", "y"], [n, 3])
    assert sf.columns == ["x", "y", "x_bucket", "y_bucket"]


def test_proxy_profile(spark):
    from tests.conftest import SF0001
    from duotower.sources.ratings import proxy_ratings

    p = profile_counts(proxy_ratings(spark, SF0001)).first()
    assert p.n_rows == 6000 and p.n_null_user == 0 and not math.isnan(p.mean_rating)


def test_sorted_head_copies_spread(spark):
    rows = [("hot", 1, 1.0)] * 3000 + [("u%d" % i, i, 2.0) for i in range(3000)]
    df = spark.createDataFrame(rows, RS)
    head = sorted_head(df, 4000, ["userId", "movieId"], 6)
    assert head.count() == 4000 and head.where(F.col("userId") == "hot").count() == 3000
    ranked = global_row_index(df.withColumn("t", F.monotonically_increasing_id()),
                              [F.col("userId"), F.col("movieId"), F.col("t")], 6, "r")
    per_part = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_part) < 3000


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=40), st.integers(1, 1000))
def test_pmod_always_in_range(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    got = [r.b for r in df.select(to_bucket(F.col("x"), n, zero_is_missing=False).alias("b")).collect()]
    assert got == [i % n for i in ids]


def test_prepare_plan_has_no_python(spark):
    from tests.conftest import SF0001
    from duotower.plans.prepare import prepare
    from duotower.sources.ratings import proxy_ratings

    df = prepare(proxy_ratings(spark, SF0001), 4)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_first_row_and_current_user(spark):
    from duotower.operators.sort import first_row
    from duotower.sources.ratings import current_user

    assert first_row(spark.range(10)).count() == 1
    assert current_user(spark).first()["current_user"]


def test_prepare_limit_and_random_split(spark):
    from duotower.plans.prepare import prepare

    rows = [("u%d" % (i % 13), i % 17, float(i % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, RS)
    head = prepare(df, 3, limit=100)
    assert head.count() == 100
    # the head is the first 100 rows by (userId, movieId, rating)
    firsts = sorted(rows, key=lambda r: (r[0], r[1], r[2]))[:100]
    assert head.select("movieId").groupBy().sum().first()[0] == sum(r[1] for r in firsts)
    rnd = prepare(df, 3, split_method="random")
    assert rnd.count() == 500 and set(r.split for r in rnd.select("split").distinct().collect()) <= {
        "train", "validation", "test"}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=80), st.integers(1, 9))
def test_global_row_index_is_a_permutation(spark, vals, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "a long, b long")
    got = global_row_index(df, [F.desc("a"), F.asc("b")], parts).orderBy("index").collect()
    want = sorted(((v, i) for i, v in enumerate(vals)), key=lambda t: (-t[0], t[1]))
    assert [r["index"] for r in got] == list(range(len(vals)))
    assert [(r.a, r.b) for r in got] == want
