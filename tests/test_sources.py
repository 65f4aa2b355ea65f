"""Readers and writers (S1-S5, S7) on temporary folders."""

import tempfile

import pytest
from pyspark.sql import functions as F

from loanlens.sources import files as FI
from loanlens.sources import fixtures as FX
from loanlens.sources import predlog as PL


def test_write_read_roundtrip(spark, sf_dir):
    apps = FX.applications(spark, sf_dir).select("application_id", "age", "grade",
                                                 F.col("dflt").alias("default"))
    d = tempfile.mkdtemp(prefix="ll-src-")
    p = FI.write_dataset(apps, d, "apps.parquet")
    df, profile = FI.load_dataset(spark, p)
    assert df.count() == apps.count()
    assert profile.first().n_features == 3
    c = FI.write_dataset(apps, d, "apps.csv")
    back = FI.enforce_schema(FI.read_dataset(spark, c))
    assert dict(back.dtypes)["age"] == "double" and dict(back.dtypes)["default"] == "int"
    with pytest.raises(ValueError):
        FI.write_dataset(apps, d, "apps.xlsx")
    with pytest.raises(FileNotFoundError):
        FI.read_dataset(spark, d + "/missing.parquet")


def test_enforce_schema_coerces(spark):
    df = spark.createDataFrame([("abc", "nan", "1", "0.3"), ("42", "A", "0", "0.1")],
                               "age string, grade string, default string, default_probability_true string")
    out = FI.enforce_schema(df).collect()
    assert out[0].age is None and out[0].grade is None and out[1].age == 42.0
    assert "default_probability_true" not in out[0].asDict()


def test_log_append_partitioned(spark, sf_dir):
    df = spark.createDataFrame([("A1", 0.1, "RENT"), ("A2", 0.9, "OWN")],
                               "application_id string, default_probability double, home_ownership string")
    rows = PL.log_rows(df, ["home_ownership"], model_version="v1")
    d = tempfile.mkdtemp(prefix="ll-log-")
    PL.append_predictions(rows, d + "/log")
    PL.append_predictions(rows, d + "/log")
    back = spark.read.parquet(d + "/log")
    assert back.count() == 4 and "date" in back.columns
    assert sorted(r.decision for r in back.collect()) == ["APPROVE", "APPROVE", "DECLINE", "DECLINE"]


def test_write_report(spark):
    d = tempfile.mkdtemp(prefix="ll-rep-")
    FI.write_report(spark.createDataFrame([("x", 0.1)], "feature string, iv double"), d + "/iv")
    assert spark.read.option("header", "true").csv(d + "/iv").count() == 1


def test_streams_on_unordered_files(spark, sf_dir, tmp_path):
    """Four files whose event times overlap give what one file gives."""
    import os

    import pyarrow.parquet as pq

    from loanlens.streaming import streams
    for name in os.listdir(sf_dir):
        if not name.startswith("orders"):
            os.symlink(os.path.join(sf_dir, name), tmp_path / name)
    orders = pq.read_table(f"{sf_dir}/orders.parquet")
    for i in range(4):
        pq.write_table(orders.take(list(range(i, len(orders), 4))),
                       tmp_path / ("orders.parquet" if i == 0 else f"orders_{i}.parquet"))
    ids = [{r[0] for r in spark.read.parquet(streams.stream_score(spark, str(d))).select("application_id").collect()}
           for d in (sf_dir, tmp_path)]
    assert ids[0] == ids[1] and ids[0]


def test_stream_writes_a_file_per_date(spark, sf_dir):
    """Each date is written by one task, so files grow with dates, not with dates x tasks."""
    from pyspark.sql import functions as F

    from loanlens.streaming import streams
    log = spark.read.parquet(streams.stream_score(spark, sf_dir)).withColumn("file", F.input_file_name())
    per_date = log.groupBy("date").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))
    most = per_date.agg(F.max("files"), F.max("n")).first()
    assert most[0] == 1 and most[1] > 1


def test_replayed_drift_batch_changes_nothing(spark, sf_dir, tmp_path):
    from loanlens.sources import fixtures as FX
    from loanlens.streaming import streams
    log = FX.prediction_log(spark, sf_dir)
    paths = str(tmp_path / "log"), str(tmp_path / "report")
    found = []
    for _ in range(2):
        streams.record_batch(log.where("id % 2 = 0"), 0, *paths)
        streams.record_batch(log.where("id % 2 = 1"), 1, *paths)
        found.append(spark.read.parquet(paths[1]).orderBy("batch_id").collect())
    assert spark.read.parquet(paths[0]).count() == log.count()
    assert found[0] == found[1] and len(found[0]) == 2
