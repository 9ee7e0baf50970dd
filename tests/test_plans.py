"""Plan properties that matter at scale: what is shuffled, scanned, broadcast
and written (checked on the physical plan, not on timings)."""

import contextlib
import io
import re
from datetime import timedelta

from pyspark.sql import functions as F

from petalframe import session
from petalframe.operators import metrics, pit, sampling


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _count(plan: str, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}\b", plan, re.M))


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(1000).withColumn("y", F.col("id") * 2)
    m, rows = session.materialize_counted(df, "t")
    assert rows == 1000 and m.count() == 1000
    ckpt = spark.sparkContext.getCheckpointDir().rstrip("/")
    files = m.inputFiles()
    assert files and all(ckpt.replace("file:", "") in f for f in files)


def test_scratch_tables_go_at_the_end(spark, tmp_path):
    import os

    kept = session.materialize(spark.range(5), "kept")
    with session.scratch(spark) as path:
        with session.scratch(spark) as inner:
            session.materialize(spark.range(10), "a")
            assert inner.startswith(path)
        assert not os.path.exists(inner.replace("file:", ""))
        m = session.materialize(spark.range(20), "b")
        m.write.parquet(str(tmp_path / "out"))
        assert all(path.replace("file:", "") in f for f in m.inputFiles())
    assert not os.path.exists(path.replace("file:", "")) and kept.count() == 5
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_bounded_broadcast_checks_size(spark):
    small, n = session.bounded_broadcast(spark.range(10), max_rows=100)
    big, m = session.bounded_broadcast(spark.range(1000), max_rows=100)
    assert (n, m) == (10, 1000)
    probe = spark.range(5000).withColumnRenamed("id", "k")
    with_hint = _plan(probe.join(small.withColumnRenamed("id", "k"), "k"))
    assert _count(with_hint, "BroadcastExchange") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # over the bound there is no hint: the planner is free to shuffle
        without = _plan(probe.join(big.withColumnRenamed("id", "k"), "k"))
        assert _count(without, "BroadcastExchange") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_selection_pass_shuffles_no_rows(spark):
    """The final pass of the stratified split is narrow - one scan of the
    input and a broadcast threshold table, no exchange of the input rows."""
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"))
    out = sampling.stratified_split(df, "id", "s", 0.3, seed=1, digits=2)
    plan = _plan(out)
    assert _count(plan, "Exchange") == 0
    assert _count(plan, "Range") == 1
    got = out.groupBy("s", "split").count().collect()
    assert sum(r["count"] for r in got if r["split"] == "test") == 6000


def test_metrics_read_confusion_once(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("y"), (F.col("id") % 2).alias("p"))
    plan = _plan(metrics.classification_metrics(df, "y", "p"))
    assert _count(plan, "Range") == 1
    assert _count(plan, "Union") == 0


def test_as_of_join_reads_each_input_once(spark, tmp_path, monkeypatch):
    """The plan that joins scans spine and features once each, in one
    exchange; the feature scan carries the time the spine covers; what the
    caller gets reads the written rows and a broadcast of one row a range."""
    spine = spark.range(500).select((F.col("id") % 7).alias("k"),
                                    F.timestamp_seconds(F.col("id") * 600).alias("ts"), "id")
    spark.range(400).select((F.col("id") % 7).alias("k"), F.timestamp_seconds(F.col("id") * 7000).alias("ts"),
                            (F.col("id") * 1.5).alias("v")).write.parquet(str(tmp_path / "f"))
    feats, seen = spark.read.parquet(str(tmp_path / "f")), []
    forward = pit._carry_forward
    monkeypatch.setattr(pit, "_carry_forward", lambda df, *a: (seen.append(df), forward(df, *a))[1])
    out = pit.as_of_join(spine, feats, ["k"], ttl=timedelta(days=1))
    inner, outer = _plan(seen[0]), _plan(out)
    assert (_count(inner, "Range"), _count(inner, "Scan parquet"), _count(inner, "Exchange")) == (1, 1, 1)
    assert re.search(r"PushedFilters: .*LessThanOrEqual\(ts.*GreaterThanOrEqual\(ts", inner)
    assert _count(outer, "Range") == 0 and _count(outer, "Exchange") == 0 and "as-of" in outer
    assert out.count() == 500
