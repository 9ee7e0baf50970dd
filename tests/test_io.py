"""Scans and sinks (S1-S5, S9, S11-S13) and definitions (K1)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from petalframe.defs import BatchSource, Entity, FeatureView, Field, Project
from petalframe.sources import io


def test_csv_roundtrip_and_guarded_load(spark, tmp_dir):
    df = spark.createDataFrame([(5.1, 3.5, "setosa"), (6.2, 2.9, "virginica")],
                               "sepal_length double, sepal_width double, species string")
    io.write_csv(df, tmp_dir + "/csv")
    back = io.read_csv(spark, tmp_dir + "/csv", "sepal_length double, sepal_width double, species string")
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(io.MissingInput, match="poison_data"):
        io.guarded_load(spark, tmp_dir + "/nope", "poison_data")


def test_level_family_and_metadata(spark, tmp_dir):
    df = spark.createDataFrame([(0, 1.0), (5, 2.0), (5, 3.0), (50, 4.0)], "poisoning_level int, x double")
    io.write_parquet(df, tmp_dir + "/levels", partition_by=["poisoning_level"])
    assert io.read_level(spark, tmp_dir + "/levels", 5).count() == 2
    sp = spark.createDataFrame([("train",), ("train",), ("test",)], "split string")
    r = io.run_metadata(sp, "split", 42).first()
    assert (r["total_samples"], r["training_samples"], r["test_samples"], r["random_seed"]) == (3, 2, 1, 42)


def test_latest_partition_and_served_log(spark, tmp_dir):
    t = datetime(2026, 7, 26, 16, 1, 30)
    runs = spark.createDataFrame([(t, 1), (t + timedelta(seconds=48), 2), (t + timedelta(seconds=48), 3)],
                                 "run_ts timestamp_ntz, v int")
    assert sorted(r["v"] for r in io.latest_partition(runs, "run_ts").collect()) == [2, 3]
    assert spark.range(1).select(io.run_partition_name(F.lit(t))).first()[0] == "20260726_160130"
    served = spark.createDataFrame([(1001, t, 0.5)], "driver_id bigint, ts timestamp_ntz, conv_rate double")
    io.log_served_features(served, tmp_dir + "/served", "ts")
    io.log_served_features(served, tmp_dir + "/served", "ts")
    logged = spark.read.parquet(tmp_dir + "/served")
    assert logged.count() == 2 and "log_date" in logged.columns


def test_definitions_validate(spark):
    e = Entity("driver", ["driver_id"])
    with pytest.raises(ValueError):
        Entity("bad", [])
    with pytest.raises(ValueError):
        FeatureView("v", [e], [Field("a"), Field("a")], BatchSource("s", frame=None))
    v = FeatureView("v", [e], [Field("a"), Field("b")], BatchSource("s", frame=None))
    with pytest.raises(KeyError):
        v[["zzz"]]
    p = Project("demo").apply([e, v])
    with pytest.raises(ValueError):
        p.apply([FeatureView("v", [e], [Field("a")], BatchSource("s", frame=None))])
    src = BatchSource("s", "ts", frame=spark.createDataFrame([(1, "x")], "driver_id bigint, ts string"))
    with pytest.raises(TypeError):
        src.load(spark)


def test_served_log_days_and_times(spark, tmp_dir):
    from datetime import datetime

    rows = spark.createDataFrame([(1, datetime(2024, 1, 1, 23)), (2, datetime(2024, 1, 2, 1))], "k int, ts timestamp_ntz")
    io.log_served_features(rows, tmp_dir + "/log", "ts")
    io.log_served_features(rows, tmp_dir + "/log", "ts", F.lit("2024-05-05 00:00:00").cast("timestamp"))
    assert io.read_served_log(spark, tmp_dir + "/log").count() == 4
    day = io.read_served_log(spark, tmp_dir + "/log", "2024-01-02", "2024-01-03")
    assert {r["k"] for r in day.collect()} == {2} and day.where("served_at is null").count() == 0
    assert io.with_ingest_time(rows).select("ingest_timestamp").distinct().count() == 1
