"""Structured Streaming jobs: ST1-ST6.

Every job reads a file stream, keeps its progress in a checkpoint folder
(under the shared ``spark.checkpoint.dir``) and writes through
``foreachBatch``. Writers are keyed by the stream (its checkpoint) and the
batch id: a batch that is replayed after a failure overwrites its own output
instead of adding to it, and streams with checkpoints of their own can share a
folder or a table without touching each other's output.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.defs import FeatureView, LabelView, OnDemandFeatureView
from petalframe.operators import online
from petalframe.operators.checks import validate


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder or glob with a fixed schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available_now(writer, checkpoint: str) -> None:
    """Process everything available, then stop (batch-style run of a stream)."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_id(checkpoint: str) -> str:
    """Names a stream by its checkpoint: a restart from it replays batches of the
    same name, a new checkpoint is another stream."""
    return "stream-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def once_per_batch(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that reads its micro-batch more than once
    (two sinks, a statistic and a merge) gets it persisted for the call, so
    the batch - source read included - runs once. Used for the writers of
    stateless streams; the output of a stateful update-mode aggregation is
    not cached (Spark 4.1 fails to substitute a cached stateful batch)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def _to_ltz(df: DataFrame, ts: str) -> DataFrame:
    """``withWatermark`` needs TIMESTAMP; the session zone is UTC, so the cast keeps the value."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


# ------------------------------------------------------------- ST1 / ST6


def push_stream(spark: SparkSession, stream: DataFrame, store: online.OnlineStore, view: FeatureView,
                checkpoint: str, offline_path: str | None = None) -> None:
    """ST1: every event goes to the offline history and to the latest table;
    late events lose by event time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.push(view, batch, offline_path=offline_path, version=batch_id, source=stream_id(checkpoint))

    run_available_now(stream.writeStream.foreachBatch(once_per_batch(write)), checkpoint)


def label_push_stream(spark: SparkSession, stream: DataFrame, table: online.VersionedTable, view: LabelView,
                      checkpoint: str, ts: str = "event_timestamp") -> None:
    """ST6: pushed labels merged with last-write-wins (K7)."""

    def resolve(rows: DataFrame, keys: list) -> DataFrame:
        return online.resolve_labels(rows, view, ts, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, view.join_keys, resolve, source=stream_id(checkpoint), batch=batch_id)

    run_available_now(stream.writeStream.foreachBatch(once_per_batch(write)), checkpoint)


# ------------------------------------------------------------------ ST2


def latest_state_stream(stream: DataFrame, keys: list, ts: str, table: online.VersionedTable,
                        checkpoint: str, created: str | None = None) -> None:
    """ST2: latest value per key kept as streaming aggregation state
    (``outputMode("update")``); each batch's changed keys are merged into the
    buckets of a versioned latest table that they fall into. No watermark is
    needed for correctness (event time decides), state holds one row per key."""
    agg = online.latest_per_key(stream, keys, ts, created)

    def resolve(rows: DataFrame, keys: list) -> DataFrame:
        return online.latest_per_key(rows, keys, ts, created)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, keys, resolve, source=stream_id(checkpoint), batch=batch_id)

    run_available_now(agg.writeStream.outputMode("update").foreachBatch(write), checkpoint)


# ------------------------------------------------------------------ ST3


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], fields: list, json_fields: dict,
                 out_path: str, rejects_path: str, checkpoint: str) -> None:
    """ST3: typed ingest (K6), scoring, append to a file sink; rows that fail
    validation go to a rejects folder so that a bad row never stops the
    stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        ok, bad = validate(batch, fields, json_fields)
        score(ok).write.mode("overwrite").parquet(batch_folder(out_path, checkpoint, batch_id))
        bad.write.mode("overwrite").parquet(batch_folder(rejects_path, checkpoint, batch_id))

    run_available_now(stream.writeStream.foreachBatch(once_per_batch(write)), checkpoint)


def batch_folder(path: str, checkpoint: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/stream={stream_id(checkpoint)}/batch={batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What the streams that share ``path`` have written."""
    return spark.read.parquet(path).drop("stream", "batch")


# ------------------------------------------------------------------ ST5


def on_demand_stream(stream: DataFrame, odfv: OnDemandFeatureView, out_path: str, checkpoint: str) -> None:
    """ST5: the same on-demand transformation as in batch, on a stream. (The file
    sink would skip a second stream's first batches: it knows them by number.)"""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(out_path, checkpoint, batch_id))

    run_available_now(odfv.apply(stream).writeStream.foreachBatch(write), checkpoint)


# ------------------------------------------------------------------ ST4

LOG_SCHEMA = "severity STRING, message STRING, timestamp STRING"
REQUEST_RE = r"^(\S+) (\S+) (\d{3}) ([0-9.]+)ms$"


def parse_request_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON log line -> (ts, method, path, status, latency_ms); lines of
    other shapes give NULL method and are dropped."""
    j = F.from_json(F.col(col), LOG_SCHEMA)
    msg = j.getField("message")
    parsed = lines.select(
        F.to_timestamp(j.getField("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS").alias("ts"),
        F.regexp_extract(msg, REQUEST_RE, 1).alias("method"),
        F.regexp_extract(msg, REQUEST_RE, 2).alias("path"),
        F.regexp_extract(msg, REQUEST_RE, 3).alias("status_s"),
        F.regexp_extract(msg, REQUEST_RE, 4).alias("latency_s"))
    return (parsed.where(F.col("method") != "")
            .select("ts", "method", "path", F.col("status_s").cast("int").alias("status"),
                    F.col("latency_s").cast("double").alias("latency_ms")))


PREDICTION_RE = r"^Prediction=(\S+) Latency=([0-9.]+)ms Client=(\S+)$"


def parse_prediction_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON log line -> (ts, prediction, latency_ms, client); other lines are dropped."""
    j = F.from_json(F.col(col), LOG_SCHEMA)
    msg = j.getField("message")
    parsed = lines.select(F.to_timestamp(j.getField("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS").alias("ts"),
                          *[F.regexp_extract(msg, PREDICTION_RE, i + 1).alias(c) for i, c in enumerate(("prediction", "latency", "client"))])
    return parsed.where(F.col("prediction") != "").select("ts", "prediction", F.col("latency").cast("double").alias("latency_ms"), "client")


def latency_step(us: Column) -> Column:
    """Microseconds cut to three significant digits: at most 900 steps a decade."""
    width = F.pow(F.lit(10.0), F.greatest(F.length(us.cast("string")) - 3, F.lit(0))).cast("long")
    return us - us % width


def request_metrics(parsed: DataFrame, window: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """ST4: counts per minute, path, status and latency step. Counts add up
    across batches, tasks and streams; :func:`summarise_requests` reads means
    and percentiles from them."""
    p = _to_ltz(parsed, "ts").withWatermark("ts", watermark).withColumn("us", F.round(F.col("latency_ms") * 1000).cast("long"))
    return (p.groupBy(F.window("ts", window).alias("w"), "path", "status", latency_step(F.col("us")).alias("step_us"))
            .agg(F.count(F.lit(1)).alias("requests"), F.sum("us").alias("total_us"), F.max("ts").alias("max_ts"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path", "status", "step_us",
                    "requests", "total_us", "max_ts"))


def summarise_requests(counts: DataFrame) -> DataFrame:
    """Per window, path and status: requests, errors, mean and p95 latency (the
    step that holds the ``ceil(0.95 n)``-th smallest), over all streams."""
    per_step = counts.groupBy("window_start", "window_end", "path", "status", "step_us").agg(
        F.sum("requests").alias("n"), F.sum("total_us").alias("us"))
    g = per_step.groupBy("window_start", "window_end", "path", "status").agg(
        F.sum("n").alias("requests"), F.sum("us").alias("us"), F.array_sort(F.collect_list(F.struct("step_us", "n"))).alias("steps"))
    need = F.expr("(95 * requests + 99) div 100")
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
    found = F.aggregate("steps", start, lambda a, x: F.struct(
        (a["seen"] + x["n"]).alias("seen"), F.coalesce(a["at"], F.when(a["seen"] + x["n"] >= need, x["step_us"])).alias("at")))
    return g.select("window_start", "window_end", "path", "status", "requests",
                    F.when(F.col("status") >= 500, F.col("requests")).otherwise(F.lit(0)).cast("long").alias("errors"),
                    (F.col("us") / F.col("requests") / 1000).alias("mean_latency_ms"), (found["at"] / 1000).alias("p95_latency_ms"))


def request_metrics_stream(lines: DataFrame, table: online.VersionedTable, checkpoint: str,
                           watermark_seconds: int = 600) -> None:
    """ST4 as a stream: update mode, each batch's changed counts merged into a
    versioned table. A row belongs to one stream (of which the newest batch
    wins); counts of several streams add up when they are read.

    Spark only promises that rows later than the watermark *may* be dropped.
    To make the result deterministic the writer keeps the largest event time
    seen by earlier batches of the stream (the mark of its commits) and ignores
    updates to windows that had already closed under that watermark: late rows
    never change a closed window.
    """
    agg = request_metrics(parse_request_log(lines), watermark=f"{watermark_seconds} seconds")
    source = stream_id(checkpoint)

    def newest(rows: DataFrame, keys: list) -> DataFrame:
        return online.latest_per_key(rows, keys, "_batch")

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = table.mark(source)
        b = batch.withColumn("stream", F.lit(source)).withColumn("_batch", F.lit(batch_id).cast("long"))
        if seen is not None:
            closed = F.lit(seen.isoformat(" ")).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(watermark_seconds))
            b = b.where(F.col("window_end").cast("timestamp_ntz") > closed)
        batch_max = batch.agg(F.max("max_ts").cast("timestamp_ntz")).first()[0]
        mark = max([t for t in (seen, batch_max) if t is not None], default=None)
        table.merge(b, ["stream", "window_start", "path", "status", "step_us"], newest, source=source, batch=batch_id, mark=mark)

    run_available_now(agg.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def read_request_metrics(table: online.VersionedTable) -> DataFrame:
    return summarise_requests(table.read())
