"""The FM baseline's one-hot vectors: those of Spark ML's encoder, without its metadata per category."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from duotower.operators.baseline import fit_fm, one_hot, one_hot_sizes, score_fm


def test_one_hot_equals_the_encoder_without_metadata(spark):
    train = spark.createDataFrame([(0, 3, 1), (2, 0, 0), (1, 1, 1), (2, 3, 0)], "userId long, movieId long, label int").coalesce(1)
    test = spark.createDataFrame([(0, 3, 1), (7, 1, 0), (1, 9, 1), (8, 8, 0)], "userId long, movieId long, label int").coalesce(1)
    numeric = [df.select(*[F.col(c).cast("double") for c in ("userId", "movieId", "label")]) for df in (train, test)]
    ohe = OneHotEncoder(inputCols=["userId", "movieId"], outputCols=["u", "m"], handleInvalid="keep")
    plain = Pipeline(stages=[ohe, VectorAssembler(inputCols=["u", "m"], outputCol="features"),
                             FMClassifier(factorSize=8, maxIter=5, stepSize=0.05, seed=42)]).fit(numeric[0])
    sizes = one_hot_sizes(train)
    got = one_hot(test, sizes)
    assert not got.schema["features"].metadata
    want = plain.transform(numeric[1])
    assert [r.features.toArray().tolist() for r in got.collect()] == [r.features.toArray().tolist() for r in want.collect()]
    probs = [r[0] for r in want.select(vector_to_array("probability")[1]).collect()]
    mine = [r.prob for r in score_fm(fit_fm(train, max_iter=5), test).collect()]
    assert all(abs(a - b) < 1e-9 for a, b in zip(mine, probs)) and len(mine) == 4
