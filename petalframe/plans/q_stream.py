"""Streaming queries: each runs a Structured Streaming job over the table as
a file stream (``trigger(availableNow=True)``) and returns what the sink holds
(ST1-ST6, F15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.defs import Field
from petalframe.operators import online
from petalframe.operators.treeshap import predict
from petalframe.plans import features_events as fe
from petalframe.plans.q_shap import ORACLE_SCORE_SQL, fixed_tree
from petalframe.plans.q_online import _ODFV
from petalframe.plans.registry import register
from petalframe.session import ensure_checkpoint_dir, work_dir
from petalframe.streaming import jobs


def _events_stream(spark, sf_dir):
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a glob lets the file source take the single parquet file of the table
    return jobs.file_stream(spark, path + "*", schema)


@register("stream_latest", """
SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type,
       arg_max(value, ts) AS value
FROM events GROUP BY user_id
""")
def stream_latest(spark, sf_dir):
    """ST2: newest event per user kept as streaming state."""
    ensure_checkpoint_dir(spark)
    base = work_dir(spark, "stream-latest")
    s = _events_stream(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    table = online.VersionedTable(spark, f"{base}/latest")
    jobs.latest_state_stream(s, ["user_id"], "ts", table, f"{base}/_checkpoint")
    return table.read()


@register("stream_push", """
SELECT user_id, max(ts) AS ts, CAST(arg_max(value, ts) AS FLOAT) AS purchase_value
FROM events WHERE event_type = 'purchase' GROUP BY user_id
""")
def stream_push(spark, sf_dir):
    """ST1/K8: pushed purchases go to the offline history and the online table."""
    base = work_dir(spark, "stream-push")
    d = fe.build(sf_dir)
    s = (_events_stream(spark, sf_dir).where(F.col("event_type") == "purchase")
         .select("user_id", "ts", F.col("value").cast("float").alias("purchase_value")))
    store = online.OnlineStore(spark, f"{base}/online")
    jobs.push_stream(spark, s, store, d["purchases"], f"{base}/_checkpoint", offline_path=f"{base}/offline")
    return store.table(d["purchases"].name).read()


@register("stream_score", ORACLE_SCORE_SQL.replace("SELECT event_id, leaf,", "SELECT event_id,", 1))
def stream_score(spark, sf_dir):
    """ST3: typed ingest, fixed-tree scoring, rejects to their own folder."""
    base = work_dir(spark, "stream-score")
    tree = fixed_tree()

    def score(ok):
        feats = ok.select("event_id", (F.hour("ts") / 3.0).alias("sepal_length"),
                          (F.col("user_id") / 30.0).alias("sepal_width"),
                          (F.col("value") / 70.0).alias("petal_length"),
                          (F.col("props.k").cast("double") / 40.0).alias("petal_width"))
        return predict(feats, tree).select("event_id", "prediction")

    s = _events_stream(spark, sf_dir)
    jobs.score_stream(s, score, [Field("value", "double"), Field("props", "string")], {"props": "k INT"},
                      f"{base}/scored", f"{base}/rejects", f"{base}/_checkpoint")
    return jobs.read_batches(spark, f"{base}/scored").select("event_id", "prediction")


@register("stream_on_demand", f"""
WITH s AS (SELECT user_id, ts, value AS purchase_value,
                  CAST(json_extract_string(props, '$.k') AS BIGINT) AS basket,
                  CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 AS budget
           FROM events WHERE event_type = 'purchase')
SELECT user_id, ts, purchase_value, basket, budget, {_ODFV} FROM s
""")
def stream_on_demand(spark, sf_dir):
    """ST5: the batch on-demand view applied to a stream of purchases."""
    base = work_dir(spark, "stream-odfv")
    d = fe.build(sf_dir)
    s = (_events_stream(spark, sf_dir).where(F.col("event_type") == "purchase")
         .select("user_id", "ts", F.col("value").alias("purchase_value"), *fe.checkout_columns()))
    jobs.on_demand_stream(s, d["signals"], f"{base}/out", f"{base}/_checkpoint")
    return jobs.read_batches(spark, f"{base}/out")


@register("stream_labels", """
WITH l AS (SELECT user_id, ts AS event_timestamp, CAST(event_type = 'purchase' AS BIGINT) AS in_good_standing,
                  value AS amount, event_type AS reporter
           FROM events WHERE event_type IN ('purchase', 'error'))
SELECT user_id, event_timestamp, in_good_standing, amount, reporter, in_good_standing IN (0, 1) AS is_valid
FROM l QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, reporter DESC) = 1
""")
def stream_labels(spark, sf_dir):
    """ST6: labels pushed as a stream, last write wins."""
    base = work_dir(spark, "stream-labels")
    d = fe.build(sf_dir)
    s = (_events_stream(spark, sf_dir).where(F.col("event_type").isin("purchase", "error"))
         .select("user_id", F.col("ts").alias("event_timestamp"),
                 (F.col("event_type") == "purchase").cast("long").alias("in_good_standing"),
                 F.col("value").alias("amount"), F.col("event_type").alias("reporter")))
    table = online.VersionedTable(spark, f"{base}/labels")
    jobs.label_push_stream(spark, s, table, d["standing"], f"{base}/_checkpoint")
    return table.read()


def request_log_lines(events):
    """Log lines (JSON severity / message / timestamp) derived from events:
    request lines ``METHOD path status <ms>ms`` and, for views, prediction
    lines ``Prediction=... Latency=...ms Client=...`` that the metrics skip."""
    method = F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    req = F.format_string("%s /%s %d %.2fms", method, F.col("event_type"), status, F.col("value"))
    pred = F.format_string("Prediction=%s Latency=%.2fms Client=10.0.0.%d", F.col("event_type"), F.col("value"),
                           (F.col("user_id") % 250).cast("int"))
    msg = F.when(F.col("event_type") == "view", pred).otherwise(req)
    return events.select(F.to_json(F.struct(
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("severity"),
        msg.alias("message"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS").alias("timestamp"))).alias("value"))


@register("request_log_metrics", """
WITH r AS (
  SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, '/' || event_type AS path,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, CAST(round(value * 1000) AS BIGINT) AS us
  FROM events WHERE event_type <> 'view'),
n AS (
  SELECT *, us - us % CAST(pow(10, greatest(length(CAST(us AS VARCHAR)) - 3, 0)) AS BIGINT) AS step_us,
         row_number() OVER (PARTITION BY window_start, path, status ORDER BY us) AS nth,
         count(*) OVER (PARTITION BY window_start, path, status) AS requests
  FROM r)
SELECT window_start, path, status, requests, CASE WHEN status >= 500 THEN requests ELSE 0 END AS errors,
       round(sum(us) / requests / 1000, 6) AS mean_latency_ms,
       max(CASE WHEN nth = (95 * requests + 99) // 100 THEN step_us END) / 1000 AS p95_latency_ms
FROM n GROUP BY window_start, path, status, requests
""")
def request_log_metrics(spark, sf_dir):
    """ST4/F15: events written as JSON log lines, streamed back, parsed and
    counted per minute, path, status and latency step with a 10-minute watermark."""
    base = work_dir(spark, "request-logs")
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    request_log_lines(ev).write.mode("overwrite").text(f"{base}/landing")
    lines = spark.readStream.format("text").load(f"{base}/landing")
    table = online.VersionedTable(spark, f"{base}/metrics")
    jobs.request_metrics_stream(lines, table, f"{base}/_checkpoint")
    m = jobs.read_request_metrics(table)
    return m.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "path", "status",
                    "requests", "errors", F.round("mean_latency_ms", 6).alias("mean_latency_ms"), "p95_latency_ms")


@register("prediction_log", """
SELECT date_trunc('milliseconds', ts) AS ts, event_type AS prediction, round(value, 2) AS latency_ms, '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS client
FROM events WHERE event_type = 'view'
""")
def prediction_log(spark, sf_dir):
    """the prediction lines of the same log."""
    base = work_dir(spark, "prediction-logs")
    request_log_lines(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")).write.text(f"{base}/landing")
    out = jobs.parse_prediction_log(spark.read.text(f"{base}/landing"))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_push_batches", """
WITH p AS (SELECT user_id, ts, CAST(value AS FLOAT) AS purchase_value FROM events WHERE event_type = 'purchase'),
l AS (SELECT user_id, max(ts) AS ts, max(purchase_value) FILTER (WHERE newest) AS purchase_value
      FROM (SELECT *, ts = max(ts) OVER (PARTITION BY user_id) AS newest FROM p) GROUP BY user_id)
SELECT 'online' AS side, user_id, ts, purchase_value FROM l
UNION ALL SELECT 'offline', user_id, ts, purchase_value FROM p
""")
def stream_push_batches(spark, sf_dir):
    """ST1/K8/S7: purchases landed as three files and pushed by two streams of one
    table (one file, then two batches): both the offline history and the online rows."""
    base = work_dir(spark, "stream-push-batches")
    d = fe.build(sf_dir)
    p = (spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").where(F.col("event_type") == "purchase")
         .select("user_id", "ts", F.col("value").cast("float").alias("purchase_value"), F.pmod("event_id", F.lit(3)).alias("part")))
    store = online.OnlineStore(spark, f"{base}/online")
    p.repartition("part").write.partitionBy("part").parquet(f"{base}/landing")
    for name, parts in (("first", "0"), ("second", "{1,2}")):
        s = jobs.file_stream(spark, f"{base}/landing/part={parts}", p.drop("part").schema, max_files_per_trigger=1)
        jobs.push_stream(spark, s, store, d["purchases"], f"{base}/_checkpoint-{name}", offline_path=f"{base}/offline")
    cols = ["user_id", "ts", "purchase_value"]
    online_side = store.table(d["purchases"].name).read().select(F.lit("online").alias("side"), *cols)
    return online_side.unionByName(spark.read.parquet(f"{base}/offline").select(F.lit("offline").alias("side"), *cols))
