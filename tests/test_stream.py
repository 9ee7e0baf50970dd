"""Structured Streaming jobs (ST1-ST6): multi-file streams equal the batch
operators, replays change nothing, late rows beyond the watermark drop."""

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from petalframe.defs import BatchSource, Entity, FeatureView, Field
from petalframe.operators import online
from petalframe.streaming import jobs

T0 = datetime(2024, 1, 1)
SCHEMA = "k bigint, ts timestamp_ntz, v double"


def _land(spark, base, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{base}/landing/b{i}")
        time.sleep(1.1)  # the file source orders files by modification time
    return jobs.file_stream(spark, f"{base}/landing/*", spark.createDataFrame([], SCHEMA).schema,
                            max_files_per_trigger=1)


def test_latest_state_equals_batch_and_late_event_loses(spark, tmp_dir):
    batches = [[(1, T0, 1.0), (2, T0, 2.0)], [(1, T0 + timedelta(hours=1), 3.0)],
               [(1, T0 - timedelta(hours=5), -1.0), (3, T0, 4.0)]]  # last batch holds a late event
    s = _land(spark, tmp_dir, batches)
    table = online.VersionedTable(spark, tmp_dir + "/latest")
    jobs.latest_state_stream(s, ["k"], "ts", table, tmp_dir + "/ck")
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert got == {1: 3.0, 2: 2.0, 3: 4.0}
    assert table.current()["version"] == 3  # one version per micro-batch


def test_push_stream_offline_and_online(spark, tmp_dir):
    s = _land(spark, tmp_dir, [[(1, T0, 1.0)], [(1, T0 + timedelta(minutes=1), 2.0), (2, T0, 5.0)]])
    view = FeatureView("fresh", [Entity("e", ["k"])], [Field("v", "double")], BatchSource("b", "ts", frame=None))
    store = online.OnlineStore(spark, tmp_dir + "/online")
    jobs.push_stream(spark, s, store, view, tmp_dir + "/ck", offline_path=tmp_dir + "/offline")
    assert {r["k"]: r["v"] for r in store.table("fresh").read().collect()} == {1: 2.0, 2: 5.0}
    assert spark.read.parquet(tmp_dir + "/offline").count() == 3
    # a replayed batch of this stream is a no-op
    again = spark.createDataFrame([(1, T0 + timedelta(days=9), 99.0)], SCHEMA)
    store.push(view, again, version=0, source=jobs.stream_id(tmp_dir + "/ck"))
    assert {r["k"]: r["v"] for r in store.table("fresh").read().collect()} == {1: 2.0, 2: 5.0}


def test_score_stream_rejects(spark, tmp_dir):
    schema = "id bigint, raw string"
    for i, rows in enumerate([[(1, "1.5"), (2, "oops")], [(3, "4")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/landing/b{i}")
    s = jobs.file_stream(spark, f"{tmp_dir}/landing/*", spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    jobs.score_stream(s, lambda ok: ok.withColumn("prediction", (F.col("raw") > 2).cast("string")),
                      [jobs_field("raw", "double")], {}, tmp_dir + "/out", tmp_dir + "/rej", tmp_dir + "/ck")
    out = {r["id"]: r["prediction"] for r in spark.read.parquet(tmp_dir + "/out").collect()}
    assert out == {1: "false", 3: "true"}
    assert [r["id"] for r in spark.read.parquet(tmp_dir + "/rej").collect()] == [2]


def jobs_field(name, dtype):
    return Field(name, dtype)


def test_request_metrics_watermark_drops_late(spark, tmp_dir):
    def line(ts, path, status, ms):
        msg = f"GET {path} {status} {ms:.2f}ms"
        return ('{"severity": "INFO", "message": "%s", "timestamp": "%s"}'
                % (msg, ts.strftime("%Y-%m-%d %H:%M:%S,") + f"{ts.microsecond // 1000:03d}"))
    b0 = [line(T0 + timedelta(seconds=10), "/a", 200, 10.0), line(T0 + timedelta(seconds=20), "/a", 200, 20.0),
          '{"severity": "INFO", "message": "Prediction=1 Latency=3.00ms Client=1.2.3.4", "timestamp": "x"}']
    b1 = [line(T0 + timedelta(hours=1), "/a", 500, 30.0)]
    b2 = [line(T0 + timedelta(seconds=30), "/a", 200, 99.0),      # 1 h late: beyond the 10 min watermark
          line(T0 + timedelta(hours=1, seconds=5), "/a", 500, 50.0)]
    for i, b in enumerate([b0, b1, b2]):
        spark.createDataFrame([(x,) for x in b], "value string").coalesce(1).write.text(f"{tmp_dir}/landing/b{i}")
        time.sleep(1.1)  # the file source orders files by modification time
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_dir}/landing/*")
    table = online.VersionedTable(spark, tmp_dir + "/m")
    jobs.request_metrics_stream(lines, table, tmp_dir + "/ck")
    got = {(r["window_start"].hour, r["status"]): (r["requests"], r["errors"], r["mean_latency_ms"], r["p95_latency_ms"])
           for r in jobs.read_request_metrics(table).collect()}
    assert got[(0, 200)] == (2, 0, 15.0, 20.0)  # the late 99 ms row was dropped
    assert got[(1, 500)] == (2, 2, 40.0, 50.0)
    # a second stream with a checkpoint of its own adds to the same windows, old ones too
    more = [line(T0 + timedelta(seconds=40), "/a", 200, 30.0), line(T0 + timedelta(hours=1, seconds=7), "/a", 500, 12.34)]
    spark.createDataFrame([(x,) for x in more], "value string").coalesce(1).write.text(f"{tmp_dir}/other/b0")
    other = spark.readStream.format("text").load(f"{tmp_dir}/other/*")
    for _ in range(2):  # run again: nothing new, nothing changes
        jobs.request_metrics_stream(other, table, tmp_dir + "/ck2")
        got = {(r["window_start"].hour, r["status"]): (r["requests"], r["errors"], round(r["mean_latency_ms"], 6), r["p95_latency_ms"])
               for r in jobs.read_request_metrics(table).collect()}
        assert got == {(0, 200): (3, 0, 20.0, 30.0), (1, 500): (3, 3, round(92.34 / 3, 6), 50.0)}


def test_p95_of_latency_steps(spark):
    import random

    rnd = random.Random(8)
    rows = [(T0, "/a" if i % 3 else "/b", 200, round(rnd.lognormvariate(3, 1.5), 2)) for i in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp, path string, status int, latency_ms double")
    counts = jobs.request_metrics(df.where("latency_ms < 20")).unionByName(jobs.request_metrics(df.where("latency_ms >= 20")))  # merged parts

    def step(us):
        width = 10 ** max(0, len(str(us)) - 3)
        return us // width * width

    for r in jobs.summarise_requests(counts).collect():
        mine = sorted(round(x * 1000) for _, p, _, x in rows if p == r["path"])
        assert r["requests"] == len(mine) and r["p95_latency_ms"] == step(mine[(95 * len(mine) + 99) // 100 - 1]) / 1000
        assert abs(r["mean_latency_ms"] - sum(mine) / len(mine) / 1000) < 1e-9


def test_two_streams_share_folders_and_tables(spark, tmp_dir):
    """ST1, ST2, ST3, ST5, ST6: batches 0, 1 of two checkpoints, into one place."""
    from petalframe.defs import LabelView, OnDemandFeatureView

    view = FeatureView("fresh", [Entity("e", ["k"])], [Field("v", "double")], BatchSource("b", "ts", frame=None))
    labels = LabelView("l", [Entity("e", ["k"])], [Field("v", "double")], None, labeler_field="who")
    odfv = OnDemandFeatureView("o", [], [Field("w", "double")], lambda r: {"w": r["v"] * 2})
    store = online.OnlineStore(spark, tmp_dir + "/online")
    latest, told = online.VersionedTable(spark, tmp_dir + "/latest"), online.VersionedTable(spark, tmp_dir + "/labels")
    rows = []
    for n in range(2):
        batches = [[(10 * n + k, T0 + timedelta(hours=b), float(10 * n + b)) for k in range(3)] + [(99, T0 + timedelta(hours=5 - n), float(n))]
                   for b in range(2)]
        rows += [r for b in batches for r in b]
        s = _land(spark, f"{tmp_dir}/{n}", batches)
        ck = f"{tmp_dir}/ck{n}-"
        jobs.push_stream(spark, s, store, view, ck + "push", offline_path=tmp_dir + "/offline")
        jobs.latest_state_stream(s, ["k"], "ts", latest, ck + "latest")
        jobs.score_stream(s, lambda ok: ok, [Field("v", "double")], {}, tmp_dir + "/scored", tmp_dir + "/rejects", ck + "score")
        jobs.on_demand_stream(s, odfv, tmp_dir + "/made", ck + "made")
        jobs.label_push_stream(spark, s.withColumn("who", F.lit(f"p{n}")), told, labels, ck + "labels", ts="ts")
    newest = {k: max((t, v) for kk, t, v in rows if kk == k)[1] for k, *_ in rows}
    assert {r["k"]: r["v"] for r in store.table("fresh").read().collect()} == newest
    assert {r["k"]: r["v"] for r in latest.read().collect()} == newest
    assert {r["k"]: r["v"] for r in told.read().collect()} == newest
    want = sorted((k, v) for k, _, v in rows)
    for path in ("offline", "scored", "made"):
        df = jobs.read_batches(spark, f"{tmp_dir}/{path}") if path != "offline" else spark.read.parquet(f"{tmp_dir}/offline")
        assert sorted((r["k"], r["v"]) for r in df.collect()) == want
    assert jobs.read_batches(spark, tmp_dir + "/made").where("w != 2 * v").count() == 0


def test_prediction_lines(spark):
    lines = ['{"severity": "INFO", "message": "Prediction=setosa Latency=3.25ms Client=1.2.3.4", "timestamp": "2024-01-01 00:00:01,500"}',
             '{"severity": "INFO", "message": "GET /a 200 1.00ms", "timestamp": "2024-01-01 00:00:01,500"}', "not json", None]
    got = jobs.parse_prediction_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["prediction"], r["latency_ms"], r["client"], r["ts"].microsecond) for r in got] == [("setosa", 3.25, "1.2.3.4", 500_000)]
