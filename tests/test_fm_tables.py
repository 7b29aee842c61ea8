"""The factorisation machine trained over slices of its coefficients equals Spark ML's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duotower.operators import baseline, fm_tables
from duotower.operators.baseline import fit_fm, score_fm

EX = "userId long, movieId long, label int"


def examples(spark, n, seed):
    """A third of the rows belongs to user 0; some rows have no label."""
    rng = np.random.default_rng(seed)
    rows = [(0 if k % 3 == 0 else int(rng.integers(0, 23)), int(rng.integers(0, 41)), None if k % 17 == 5 else int(rng.integers(0, 2))) for k in range(n)]
    return spark.createDataFrame(rows, EX).repartition(3)


def test_random_numbers_are_those_of_java(spark):
    want = spark.sparkContext._jvm.java.util.Random(42)
    want = [want.nextGaussian() for _ in range(64)]
    got = fm_tables.gaussians(42, np.array([0, len(fm_tables._pairs(42, 0, fm_tables.ATTEMPTS))]), 0, 64)
    assert np.allclose(got, want, rtol=1e-13, atol=0)
    taken = fm_tables._taken(spark, 42, 900_000)
    whole = fm_tables.gaussians(42, taken, 0, 1_800_000)
    assert np.array_equal(whole[1_640_001:1_650_000], fm_tables.gaussians(42, taken, 1_640_001, 1_650_000)) and len(whole) == 1_800_000


@pytest.mark.parametrize("slice_ids, batch_rows", [(4096, 131_072), (4, 7)])
def test_slices_give_the_model_of_spark_ml(spark, monkeypatch, slice_ids, batch_rows):
    train, test = examples(spark, 400, 1), examples(spark, 60, 2).union(spark.createDataFrame([(99, 3, 1), (2, 77, 0)], EX))
    real = fm_tables.fit_tables
    monkeypatch.setattr(baseline, "fit_tables", lambda *a: real(*a, slice_ids=slice_ids, batch_rows=batch_rows))
    plain, sliced = (fit_fm(train, max_iter=4, driver_bytes=n) for n in (baseline.DRIVER_BYTES, 0))
    assert isinstance(sliced[0], fm_tables.FMTables) and not isinstance(plain[0], fm_tables.FMTables) and sliced[1] == plain[1]
    assert abs(sliced[0].intercept - plain[0].intercept) < 1e-9

    def probs(model):
        rows = test.withColumn("label", F.coalesce("label", F.lit(0))).coalesce(1)
        return sorted((r.label, r.prob) for r in score_fm(model, rows).collect())

    want, got = probs(plain), probs(sliced)
    assert len(want) == len(got) == 62 and all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 for a, b in zip(want, got))


def test_a_null_id_is_an_error(spark):
    train = examples(spark, 40, 3)
    for bad in ((None, 1, 1), (1, -2, 0)):
        with pytest.raises(Exception, match="is null or negative"):
            fit_fm(train.union(spark.createDataFrame([bad], EX)), driver_bytes=0)
