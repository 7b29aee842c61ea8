"""Sources and sinks: CSV modes, write-once table, export + manifest, run tables, entry contract."""

import pytest
import os
import tempfile

from pyspark.sql import functions as F

from duotower.config import RunConfig, TrainArgs, args_from_json, args_to_json, relevant_fields
from duotower.sources.export import export_split, manifest, read_manifest, read_shards
from duotower.sources.ratings import read_ratings_csv, write_table_once
from duotower.sources.runs import log_metrics, log_params, read_metrics, read_params


def test_csv_modes(spark):
    d = tempfile.mkdtemp(prefix="dt-csv-")
    p = os.path.join(d, "r.csv")
    with open(p, "w") as f:
        f.write("userId,movieId,rating\na,1,4.5\nb,notanumber,3.0\nc,3,2.0\n")
    assert len(read_ratings_csv(spark, p).collect()) == 3
    assert len(read_ratings_csv(spark, p, mode="DROPMALFORMED").collect()) == 2
    bad = [r for r in read_ratings_csv(spark, p, corrupt_col="_bad").collect() if r["_bad"] is not None]
    assert len(bad) == 1 and bad[0].userId == "b"
    # columns are found by name, in any order, and a missing one is an error
    p3 = os.path.join(d, "r3.csv")
    with open(p3, "w") as f:
        f.write("movieId,timestamp,userId,rating\n77,5,10,4.5\n")
    assert [tuple(r) for r in read_ratings_csv(spark, p3).collect()] == [("10", 77, 4.5)]
    p4 = os.path.join(d, "r4.csv")
    with open(p4, "w") as f:
        f.write("movieId,userId\n77,10\n")
    with pytest.raises(ValueError):
        read_ratings_csv(spark, p4)
    # other columns are read past
    p2 = os.path.join(d, "r2.csv")
    with open(p2, "w") as f:
        f.write("userId,movieId,rating,timestamp\na,1,4.5,100\n")
    assert [tuple(r) for r in read_ratings_csv(spark, p2).collect()] == [("a", 1, 4.5)]


def test_write_once_keeps_first(spark):
    d = tempfile.mkdtemp(prefix="dt-tbl-")
    a = spark.createDataFrame([("a", 1, 1.0)], "userId string, movieId long, rating double")
    b = spark.createDataFrame([("b", 2, 2.0), ("c", 3, 3.0)], "userId string, movieId long, rating double")
    assert write_table_once(a, "t_once_test", path=d) is True
    assert write_table_once(b, "t_once_test", path=d) is False
    assert [r.userId for r in spark.table("t_once_test").collect()] == ["a"]


def test_export_manifest_skip(spark):
    root = tempfile.mkdtemp(prefix="dt-exp-")
    df = spark.range(1000).select((F.col("id") % 2).alias("label"), F.col("id").alias("userId"),
                                  (F.col("id") * 3).alias("movieId"))
    assert export_split(df, f"{root}/s", num_shards=5) is True
    assert export_split(df, f"{root}/s", num_shards=5) is False
    m = manifest(spark, f"{root}/s")
    assert m.count() == 5 and m.agg(F.sum("rows")).first()[0] == 1000
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(f"{root}/s") if f.startswith("part-"))
    r = read_shards(spark, f"{root}/s")
    assert [f.name for f in r.schema.fields] == ["label", "userId", "movieId", "row_id"]
    assert dict(r.dtypes)["label"] == "int" and r.select("row_id").distinct().count() == 1000


def test_run_tables_and_config(spark):
    root = tempfile.mkdtemp(prefix="dt-runs-")
    args = TrainArgs()
    log_params(spark, root, "r1", relevant_fields(args, ["userId", "movieId"], [10, 20]))
    log_metrics(spark, root, "r1", "base", None, {"val_auroc": 0.5})
    log_metrics(spark, root, "r1", "epoch", 0, {"val_auroc": 0.6})
    assert read_params(spark, root).count() == 1
    assert sorted((r.phase, r.step) for r in read_metrics(spark, root).collect()) == [("base", None), ("epoch", 0)]
    assert args_from_json(args_to_json(args)) == args
    assert RunConfig().qualified_table == "users.default.ratings"
    try:
        RunConfig(volume_name="")
        raise AssertionError("empty name accepted")
    except ValueError:
        pass


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert sorted(r.split for r in df.collect()) == ["test", "train", "validation"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_model_validity_checks():
    import pytest

    from duotower.config import validate_model

    validate_model(["userId", "movieId"], [3, 4], [8, 8])
    with pytest.raises(ValueError):
        validate_model(["userId"], [3], [8])
    with pytest.raises(ValueError):
        validate_model(["userId", "movieId"], [3, 4], [8, 16])
    with pytest.raises(ValueError):
        TrainArgs(batch_size=0)


def test_export_splits_one_write(spark):
    from duotower.sources.export import export_splits

    root = tempfile.mkdtemp(prefix="dt-exps-") + "/export"
    df = spark.range(3000).select((F.col("id") % 2).alias("label"), F.col("id").alias("userId"),
                                  (F.col("id") % 97).alias("movieId"),
                                  F.element_at(F.array(F.lit("train"), F.lit("validation"), F.lit("test")),
                                               (F.col("id") % 3 + 1).cast("int")).alias("split"))
    assert export_splits(df, root) is True and export_splits(df, root) is False
    counts = {s: read_shards(spark, f"{root}/split={s}").count() for s in ("train", "validation", "test")}
    assert counts == {"train": 1000, "validation": 1000, "test": 1000}
    assert manifest(spark, f"{root}/split=train").agg(F.sum("rows")).first()[0] == 1000
    saved = read_manifest(spark, root)
    assert {r.split: r.n for r in saved.groupBy("split").agg(F.sum("rows").alias("n")).collect()} == counts
    assert spark.read.parquet(root).count() == 3000        # the manifest does not leak into the data
