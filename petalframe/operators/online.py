"""Latest-value tables: materialisation, online lookup, labels.

The latest table has one row per entity key. It is computed by a grouped
``max_by(row, (event time, created time))`` - an aggregate that combines
partially before the shuffle, so a hot key costs one partial row per task,
not a third of the data in one task.

A stored table (:class:`VersionedTable`) is cut into hash buckets of its key; a
merge rewrites only the buckets its rows fall into. A version is a small commit
file that names the folder of every bucket, created after the data is complete
and never overwritten: a job killed half-way leaves the previous version in
place, and of two writers the slower one merges again into the other's result.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime
from typing import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.defs import FeatureService, FeatureView, LabelView
from petalframe.operators.checks import validate
from petalframe.operators.pit import drop_inputs, features_needed, orderable
from petalframe.session import materialize
from petalframe.sources.io import log_served_features


def _cols(cs) -> list:
    return [cs] if isinstance(cs, str) else list(cs or [])


def latest_per_key(df: DataFrame, keys: list, ts: str, created: str | None = None,
                   cols: list | None = None) -> DataFrame:
    """Newest row per key by (ts, created); all other columns ride along. Of equal
    times the row with the larger values wins, column by column."""
    keys = _cols(keys)
    cols = cols or [c for c in df.columns if c not in keys]
    first = [ts, *([created] if created else [])]
    order = F.struct(*[F.col(c) for c in first + [c for c in orderable(df) if c in cols and c not in first]])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
            .select(*keys, "_r.*"))


def slice_rows(history: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with ``start < ts <= end`` (start exclusive, end inclusive)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) > F.lit(start).cast(history.schema[ts].dataType))
    if end is not None:
        cond = cond & (F.col(ts) <= F.lit(end).cast(history.schema[ts].dataType))
    return history.where(cond)


def materialize_frame(history: DataFrame, snapshot: DataFrame | None, keys: list, ts: str,
                      created: str | None = None, start=None, end=None) -> DataFrame:
    """K2 as a plan: (new slice) union (previous snapshot) -> latest per key.

    A late row older than the snapshot's row for its key loses by event time;
    equal times are decided by ``created``.
    """
    new = slice_rows(history, ts, start, end)
    if snapshot is not None:
        new = new.unionByName(snapshot.select(*new.columns))
    return latest_per_key(new, keys, ts, created)


def online_lookup(requests: DataFrame, latest: DataFrame, keys: list, features: list,
                  order_col: str | None = None) -> DataFrame:
    """Per request row the latest features of its key; a missing key gives
    NULLs; repeated keys are all answered; ``order_col`` keeps request order.

    A left join: AQE broadcasts whichever side is small at run time and
    splits skewed request keys when both are large.
    """
    keys = _cols(keys)
    out = requests.join(latest.select(*keys, *features), keys, "left")
    return out.orderBy(order_col) if order_col else out


def resolve_labels(labels: DataFrame, view: LabelView, ts: str = "event_timestamp", keys: list | None = None) -> DataFrame:
    """K7: LAST_WRITE_WINS by event time, labeler name breaking ties; adds
    ``is_valid`` from the view's allowed label values."""
    out = latest_per_key(labels, keys or view.join_keys, ts, view.labeler_field)
    ok = F.lit(True)
    for fld, values in view.allowed_values.items():
        ok = ok & F.coalesce(F.col(fld).cast("string").isin(*values), F.lit(False))
    return out.withColumn("is_valid", ok)


def join_latest_labels(spine: DataFrame, labels: DataFrame, view: LabelView,
                       ts: str = "event_timestamp") -> DataFrame:
    """Latest label per key onto a spine (left join)."""
    latest = resolve_labels(labels, view, ts)
    return spine.join(latest, view.join_keys, "left")


# ------------------------------------------------------------------ stores


#: Hash buckets of a stored table; commits whose data stays readable.
BUCKETS, KEEP = 64, 10


class VersionedTable:
    """Rows resolved per key, in hash buckets, with one commit file per version.

    A commit (``_log/<version>.json``) holds the whole state: the folder of each
    bucket, the schema, ``end_ts``, and for every source (a stream, a pusher) its
    batches and a mark. A batch that a source has already, replayed, changes
    nothing. ``keep`` commits stay readable: the folders that only older
    ones name are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.path, self.buckets, self.keep = spark, path.rstrip("/"), buckets, keep

    # ---- commit files (metadata only, through the file system Spark uses)

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _state(self, version: int) -> dict | None:
        path, fs = self._file(f"_log/{version:012d}.json")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, state: dict) -> bool:
        """False if another writer has taken this version."""
        path, fs = self._file(f"_log/{state['version']:012d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception) or fs.exists(path):
                return False
            raise
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        return True

    def _newest(self) -> dict | None:
        path, fs = self._file("_log")
        if not fs.exists(path):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        return self._state(max(versions)) if versions else None

    def current(self) -> dict | None:
        """``version``, ``end_ts`` and ``sources`` of the newest commit."""
        s = self._newest()
        if s is None:
            return None
        return {"version": s["version"], "end_ts": s["end_ts"] and datetime.fromisoformat(s["end_ts"]), "sources": s["sources"]}

    def mark(self, source: str) -> datetime | None:
        """What this source's last commit noted (a stream's largest event time)."""
        told = ((self.current() or {}).get("sources", {}).get(source) or {}).get("mark")
        return told and datetime.fromisoformat(told)

    def committed(self, source: str, batch: int) -> int | None:
        """The version that holds this batch of this source, if any."""
        return _committed(self._newest(), source, batch)

    # ---- data

    def _rows(self, state: dict, buckets: list) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.path}/{state['buckets'][str(b)]}/_bucket={b}" for b in buckets if str(b) in state["buckets"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        state = self._newest() if version is None else self._state(version)
        return None if state is None else self._rows(state, list(state["buckets"]))

    def merge(self, rows: DataFrame, keys: list, resolve: Callable[[DataFrame, list], DataFrame], end_ts: datetime | None = None,
              source: str | None = None, batch: int | None = None, mark: datetime | None = None) -> int:
        """Resolve ``rows`` with the stored rows of their buckets; the new version.

        ``resolve(rows, keys)`` leaves one row per key. It is applied to the new
        rows first (a partial aggregate: a hot key comes down to one row), then
        to new and stored rows, bucket by bucket."""
        keys = _cols(keys)
        state = self._newest()
        done = _committed(state, source, batch)
        if done is not None:
            return done
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        new = materialize(resolve(rows, keys).withColumn("_bucket", bucket), "merge")
        touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # at most one number per bucket
        while True:
            both, folder = new, f"data-{uuid.uuid4().hex}"
            if state is not None:
                stored = self._rows(state, touched).withColumn("_bucket", bucket)
                both = new.unionByName(stored.select(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in new.columns]))
            if touched:
                out = resolve(both.repartition(len(touched), "_bucket"), ["_bucket", *keys])
                out.select(*new.columns).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            last = state or {"version": 0, "end_ts": None, "buckets": {}, "sources": {}}
            told = {} if source is None else {source: {"batches": _with_batch(last["sources"].get(source), batch),
                                                       "version": last["version"] + 1, "mark": mark and mark.isoformat()}}
            ok = self._commit({
                "version": last["version"] + 1, "end_ts": end_ts.isoformat() if end_ts else last["end_ts"],
                "buckets": last["buckets"] | {str(b): folder for b in touched}, "sources": last["sources"] | told,
                "schema": new.drop("_bucket").schema.jsonValue()})
            if ok:
                self._expire(last["version"] + 1 - self.keep)
                return last["version"] + 1
            state = self._newest()  # another writer was faster: merge into its result
            done = _committed(state, source, batch)
            if done is not None:
                return done

    def _expire(self, version: int) -> None:
        """Delete the commit and the bucket folders that only commits up to it name."""
        old, after = (self._state(version), self._state(version + 1)) if version > 0 else (None, None)
        if old is None or after is None:
            return
        for b, folder in old["buckets"].items():
            if after["buckets"].get(b) != folder:
                path, fs = self._file(f"{folder}/_bucket={b}")
                fs.delete(path, True)
        path, fs = self._file(f"_log/{version:012d}.json")
        fs.delete(path, False)


def _committed(state: dict | None, source: str | None, batch: int | None) -> int | None:
    """The version since which the source holds this batch at the latest, if it does."""
    told = state and source is not None and batch is not None and state["sources"].get(source)
    return told["version"] if told and any(a <= batch <= z for a, z in told["batches"]) else None


def _with_batch(told: dict | None, batch: int | None) -> list:
    """A source's batches as closed ranges: one range for a stream that counts up."""
    out = []
    for a, z in sorted([*(told or {}).get("batches", []), *([] if batch is None else [[batch, batch]])]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


class OnlineStore:
    """Latest-value tables per feature view under one base folder."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def table(self, view_name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/{view_name}", self.buckets)

    @staticmethod
    def _resolve(view: FeatureView) -> Callable[[DataFrame, list], DataFrame]:
        src = view.batch_source
        return lambda rows, keys: latest_per_key(rows, keys, src.timestamp_field, src.created_timestamp_column)

    @staticmethod
    def _columns(view: FeatureView) -> list:
        src = view.batch_source
        return [*view.join_keys, src.timestamp_field, *([src.created_timestamp_column] if src.created_timestamp_column else []), *view.feature_names]

    def _checked(self, view: FeatureView, rows: DataFrame) -> DataFrame:
        """The rows of a view, checked if the view says so: rejects are appended to
        ``<view>/_rejects`` with their reason, and stay out of the table."""
        rows = rows.select(*self._columns(view))
        if not view.enable_validation:
            return rows
        ok, bad = validate(rows, view.schema)
        bad.write.mode("append").parquet(f"{self.base}/{view.name}/_rejects")
        return ok

    def rejects(self, view: FeatureView) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{view.name}/_rejects")

    def materialize_incremental(self, view: FeatureView, end, history: DataFrame | None = None) -> int:
        """K2: from the last end (exclusive) to ``end`` (inclusive); the history's
        time filter reaches its scan, and only touched buckets are rewritten."""
        src = view.batch_source
        history = history if history is not None else src.load(self.spark)
        t = self.table(view.name)
        cur = t.current()
        rows = slice_rows(history, src.timestamp_field, cur["end_ts"] if cur else None, end)
        return t.merge(self._checked(view, rows), view.join_keys, self._resolve(view), end_ts=end)

    def push(self, view: FeatureView, rows: DataFrame, offline_path: str | None = None,
             version: int | None = None, source: str = "push") -> int:
        """K8: append to the offline history and merge into the latest table.

        ``version`` (e.g. a stream's batch id) names the batch within ``source``:
        that pair, replayed, changes nothing. The history has one folder per
        push, ``batch=<source>-<version>``.
        """
        if offline_path:
            # one folder per version: a replay overwrites instead of duplicating
            name = f"{source}-{version}" if version is not None else f"{source}-{uuid.uuid4().hex}"
            rows.write.mode("overwrite").parquet(f"{offline_path.rstrip('/')}/batch={name}")
        if version is not None and self.table(view.name).committed(source, version) is not None:
            return self.table(view.name).committed(source, version)
        return self.table(view.name).merge(self._checked(view, rows), view.join_keys, self._resolve(view),
                                           source=source if version is not None else None, batch=version)

    def latest(self, view: FeatureView, features: list) -> DataFrame:
        """The stored rows of a view: join keys and features, cast to the declared types."""
        rows = self.table(view.name).read()
        if rows is None:
            raise RuntimeError(f"view {view.name!r} has not been materialised")
        types = {f.name: f.spark_type for f in view.schema}
        return rows.select(*view.join_keys, *[F.col(f).cast(types[f]).alias(f) for f in features])

    def get_online_features(self, view: FeatureView, requests: DataFrame, features: list | None = None,
                            order_col: str | None = None) -> DataFrame:
        """J7 against the stored latest table; values cast to the declared types."""
        feats = features or view.feature_names
        return online_lookup(requests, self.latest(view, feats), view.join_keys, feats, order_col)

    def get_features(self, requests: DataFrame, items: list, *, project=None, order_col: str | None = None,
                     full_feature_names: bool = False) -> DataFrame:
        """J7/K4/K5 for services, views, selections and ``"view:feature"`` names:
        one plan that joins every view's stored rows to the requests, then
        computes the on-demand features from them and the request's columns.

        Every request is answered, repeated ones too; a key that a view lacks
        gets NULLs there. ``order_col`` keeps the order of the requests. What a
        service with a ``logging_path`` serves is written there first, with the
        time, and returned as it was logged."""
        plan = features_needed(items, requests, project, full_feature_names)
        out = plan.spine
        for view, feats in plan.views:
            prefix = plan.prefix(view)
            out = out.join(self.latest(view, feats).withColumnsRenamed({f: prefix + f for f in feats}), view.join_keys, "left")
        for o in plan.on_demand:
            out = o.apply(out)
        # the request's columns first, as they came
        out = drop_inputs(out.select(*requests.columns, *[c for c in out.columns if c not in requests.columns]), plan)
        for service in [i for i in items if isinstance(i, FeatureService) and i.logging_path]:
            out = materialize(out, "served")
            log_served_features(out, service.logging_path)
        return out.orderBy(order_col) if order_col else out
