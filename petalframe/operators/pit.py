"""Point-in-time (as-of) retrieval: J1-J5, K3-K5.

Plan shape of :func:`as_of_join`: one small job takes the time the spine covers,
which prunes the feature scan (from below only with a ttl). Then spine and
feature rows meet in one exchange, range partitioned and sorted by (key, time,
features before spine rows), and each task carries the newest feature row
forward as it streams, a batch at a time. A range's bounds come from a sample
of the whole sort key, so a key - or a single instant - that holds a third of
all rows spans several ranges. What a range's first key had before the range
starts is the last feature row of an earlier range: one row a range, carried
by a window over those rows only. State is a single row; there is no range
join, and no group of rows that one task must hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.defs import (FeatureService, FeatureView, FeatureViewProjection,
                             OnDemandFeatureView)
from petalframe.operators.prefix import changes, ranged
from petalframe.session import bounded_broadcast, work_dir

DAY_SECONDS = 86400


def orderable(df: DataFrame) -> list:
    """Columns whose values can be compared (no maps, no variants)."""
    return [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]


#: Rows the carry-forward writes: matched spine rows; a range's last feature row; a range whose first spine rows look back.
_ROW, _TAIL, _HEAD = 1, 2, 3


def _carry_forward(df: DataFrame, keys: list, spine_cols: list, feature_cols: list) -> DataFrame:
    """Sorted union of spine and feature rows to spine rows with the newest
    feature row of their key in this range, and the rows that link ranges."""
    fields = {f.name: f for f in df.schema.fields}
    out_names = [*keys, "_t", *spine_cols, *feature_cols, "_open", "_range", "_kind"]
    schema = T.StructType([*[T.StructField(c, fields[c].dataType) for c in out_names[:-3]], T.StructField("_open", T.BooleanType()),
                           T.StructField("_range", T.IntegerType()), T.StructField("_kind", T.IntegerType())])

    def run(batches):
        task, last, carry, first, looks_back = TaskContext.get().partitionId(), None, None, None, False

        def linked(key, row, kind):
            """One row without spine columns: ``key`` and ``row`` are one-row slices."""
            cols = [*[key.column(c) for c in keys], key.column("_t"), *[pa.nulls(1, types[c]) for c in spine_cols],
                    *[row.column(c) if row is not None else pa.nulls(1, types[c]) for c in feature_cols],
                    pa.array([False]), pa.array([task], pa.int32()), pa.array([kind], pa.int32())]
            return pa.RecordBatch.from_arrays(cols, out_names)

        for b in batches:
            if not b.num_rows:
                continue
            types = {f.name: f.type for f in b.schema}
            n, is_spine = b.num_rows, b.column("_side").to_numpy() == 1
            key = [b.column(c)[0].as_py() for c in keys]
            go_on = last is not None and key == [last.column(c)[0].as_py() for c in keys]
            start = np.concatenate([[not go_on], changes(b, keys)])
            row = np.arange(n)
            group = np.maximum.accumulate(np.where(start, row, -1))  # first row of the key; -1: in an earlier batch
            newest = np.maximum.accumulate(np.where(is_spine, -1, row))
            match = np.where(newest >= np.maximum(group, 0), newest + 1, -1)  # 0 stands for the carried row
            if not go_on:
                carry = None
            if carry is not None:
                match[(match < 0) & (group < 0)] = 0
            # rows of the range's first key before any of its feature rows
            in_first = np.cumsum(start) == 1 if first is None else (np.cumsum(start) == 0) & (first == key)
            open_ = is_spine & (match < 0) & in_first
            if first is None:
                first = key
            if open_.any() and not looks_back:
                looks_back = b.slice(int(np.argmax(open_)), 1)
            if is_spine.any():
                take = pa.array(match[is_spine], mask=match[is_spine] < 0)
                mine = b.filter(pa.array(is_spine))
                joined = []
                for c in feature_cols:
                    head = carry.column(c) if carry is not None else pa.nulls(1, types[c])
                    joined.append(pa.concat_arrays([head, b.column(c)]).take(take))
                yield pa.RecordBatch.from_arrays(
                    [*[mine.column(c) for c in [*keys, "_t", *spine_cols]], *joined, pa.array(open_[is_spine]),
                     pa.array(np.full(mine.num_rows, task, dtype="int32")), pa.array(np.full(mine.num_rows, _ROW, dtype="int32"))], out_names)
            last = b.slice(n - 1, 1)
            if match[-1] > 0:
                carry = b.slice(int(match[-1]) - 1, 1)
            elif match[-1] < 0:
                carry = None
        if looks_back:
            yield linked(looks_back, None, _HEAD)
        if carry is not None:
            yield linked(last, carry, _TAIL)

    return df.mapInArrow(run, schema)


def as_of_join(spine: DataFrame, feats: DataFrame, keys: list, *,
               spine_ts: str = "ts", feature_ts: str = "ts",
               features: list | None = None, ttl: timedelta | None = None,
               created: str | None = None, prefix: str = "",
               feature_ts_as: str | None = None, ranges: int | None = None) -> DataFrame:
    """Left as-of join (J1) with optional ttl (J2) and created tie-break.

    For every spine row: the newest feature row with the same key and
    ``feature_ts <= spine_ts`` (and ``>= spine_ts - ttl`` when ttl is set).
    Spine rows all pass through, repeated ones included; no match gives NULL
    features, as do NULL keys and times. Of several feature rows with the same
    key and time the newest ``created`` wins, then the larger feature values,
    in the order of ``features`` (NULL smallest). Output: spine columns, then
    ``prefix + feature`` columns, then ``feature_ts_as`` (the matched row's
    time) when given. ``ranges``: partitions of the exchange (the shuffle
    partitions, by default).
    """
    keys, spark = list(keys), spine.sparkSession
    if features is None:
        features = [c for c in feats.columns if c not in keys and c not in (feature_ts, created)]
    clash = set(prefix + f for f in features) & set(spine.columns)
    if feature_ts_as:
        clash |= {feature_ts_as} & set(spine.columns)
    if clash:
        raise ValueError(f"feature names clash with spine columns: {sorted(clash)}")
    st, ft = spine.schema[spine_ts].dataType, feats.schema[feature_ts].dataType

    # the time the spine covers: no other feature row can match. Instants travel as
    # microseconds, times without a zone (and mixed types) as text in the session's zone
    exact = isinstance(st, T.TimestampType) and isinstance(ft, T.TimestampType)
    low = F.min(spine_ts) - interval(ttl) if ttl is not None else F.lit(None).cast(st)
    low, high = [F.unix_micros(c) if exact else c.cast("string") for c in (low, F.max(spine_ts))]
    bounds = spine.agg(low.alias("low"), high.alias("high")).first()

    def bound(v) -> Column:
        return F.timestamp_micros(F.lit(v).cast("bigint")) if exact else F.lit(v).cast(ft)

    wanted = F.col(feature_ts) <= bound(bounds["high"])
    if ttl is not None:
        wanted = wanted & (F.col(feature_ts) >= bound(bounds["low"]))
    for k in keys:
        wanted = wanted & F.col(k).isNotNull()

    others = [c for c in spine.columns if c not in keys and c != spine_ts]
    s_names, f_names = [f"_s{i}" for i in range(len(others))], [f"_f{i}" for i in range(len(features))]
    s_rows = spine.select(*keys, F.col(spine_ts).alias("_t"), F.lit(1).alias("_side"), *[F.col(c).alias(n) for c, n in zip(others, s_names)])
    f_rows = feats.where(wanted).select(
        *[F.col(k).cast(spine.schema[k].dataType).alias(k) for k in keys], F.col(feature_ts).cast(st).alias("_t"), F.lit(0).alias("_side"),
        *([F.col(created).alias("_created")] if created else []), *[F.col(c).alias(n) for c, n in zip(features, f_names)],
        F.col(feature_ts).cast(st).alias("_ft"))
    both = f_rows.unionByName(s_rows, allowMissingColumns=True).withColumn("_spread", F.monotonically_increasing_id())
    compared = [c for c in orderable(both) if c in f_names]
    # the last column only spreads rows that are alike in all others
    order = [*keys, "_t", "_side", *(["_created"] if created else []), *compared, "_spread"]
    path = work_dir(spark, "as-of")
    carried = _carry_forward(ranged(both, order, ranges), keys, s_names, [*f_names, "_ft"])
    carried.write.partitionBy("_kind").parquet(path)
    written = spark.read.schema(carried.schema).parquet(path)

    match = F.struct(*[F.col(n) for n in f_names], "_ft")
    links = written.where(F.col("_kind").isin(_TAIL, _HEAD)).select(*keys, "_range", "_kind", F.when(F.col("_kind") == _TAIL, match).alias("_m"))
    earlier = Window.partitionBy(*keys).orderBy("_range", F.desc("_kind")).rowsBetween(Window.unboundedPreceding, -1)
    links = links.withColumn("_m", F.last("_m", ignorenulls=True).over(earlier)).where((F.col("_kind") == _HEAD) & F.col("_m").isNotNull())
    links, _ = bounded_broadcast(links.select(F.col("_range").alias("_at"), "_m"))  # at most one row a range
    out = written.where(F.col("_kind") == _ROW).join(links, F.col("_open") & (F.col("_range") == F.col("_at")), "left")
    m = F.when(F.col("_open"), F.col("_m")).otherwise(match)
    valid = F.col("_t").isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    if ttl is not None:
        valid = valid & (m.getField("_ft") >= F.col("_t") - interval(ttl))
    out = out.withColumn("_m", F.when(valid, m))
    back = dict(zip(others, s_names)) | {k: k for k in keys} | {spine_ts: "_t"}
    cols = [F.col(back[c]).alias(c) for c in spine.columns]
    cols += [F.col("_m").getField(n).alias(prefix + c) for c, n in zip(features, f_names)]
    if feature_ts_as:
        cols.append(F.col("_m").getField("_ft").alias(feature_ts_as))
    return out.select(*cols)


def interval(td: timedelta) -> Column:
    """A timedelta as a day-time interval literal."""
    secs = td.days * DAY_SECONDS + td.seconds
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              F.lit(secs).cast("decimal(18,6)") + F.lit(td.microseconds).cast("decimal(18,6)") / 1_000_000)


# ---------------------------------------------------------------- retrieval


def _view_frame(view: FeatureView, spark=None) -> DataFrame:
    return view.batch_source.load(spark)


def resolve_references(items: list, project=None) -> tuple[list, list]:
    """Service items or ``"view:feature"`` strings (looked up in
    ``project``; a feature of an on-demand view selects that view) ->
    [(view, [features])], [odfv]."""
    views: dict = {}
    odfvs = []
    for it in items:
        if isinstance(it, str):
            name, _, feature = it.partition(":")
            if project is None or not feature:
                raise ValueError(f"{it!r}: give 'view:feature' and the project that defines the view")
            it = project.get("FeatureView", name)
            if not isinstance(it, OnDemandFeatureView):
                if feature not in it.feature_names:
                    raise KeyError(f"view {name!r} has no feature {feature!r}")
                it = (it, [feature])
        if isinstance(it, FeatureService):
            v, o = resolve_references(it.features, project)
            for view, feats in v:
                cur = views.setdefault(view.name, (view, []))[1]
                cur.extend(f for f in feats if f not in cur)
            odfvs.extend(x for x in o if x not in odfvs)
        elif isinstance(it, FeatureViewProjection):
            cur = views.setdefault(it.view.name, (it.view, []))[1]
            cur.extend(f for f in it.features if f not in cur)
        elif isinstance(it, FeatureView):
            cur = views.setdefault(it.name, (it, []))[1]
            cur.extend(f for f in it.feature_names if f not in cur)
        elif isinstance(it, OnDemandFeatureView):
            if it not in odfvs:
                odfvs.append(it)
        elif isinstance(it, tuple) and len(it) == 2:
            view, feats = it
            cur = views.setdefault(view.name, (view, []))[1]
            cur.extend(f for f in feats if f not in cur)
        else:
            raise TypeError(f"cannot resolve {it!r}")
    return list(views.values()), odfvs


@dataclass
class FeaturePlan:
    """What a retrieval fetches: per view the features (selected ones and those
    on-demand views need), the on-demand views, the checked spine."""

    spine: DataFrame
    views: list
    on_demand: list
    selected: set
    full_feature_names: bool

    def prefix(self, view: FeatureView) -> str:
        return f"{view.name}__" if self.full_feature_names else ""


def features_needed(items: list, spine: DataFrame, project=None, full_feature_names: bool = False) -> FeaturePlan:
    """Resolve what is asked for; request columns are checked and cast, duplicate
    output names are an error."""
    views, odfvs = resolve_references(items, project)
    needed = {v.name: (v, list(fs)) for v, fs in views}
    for o in odfvs:
        for src in o.input_views():
            view = src.view if isinstance(src, FeatureViewProjection) else src
            fs = src.features if isinstance(src, FeatureViewProjection) else view.feature_names
            cur = needed.setdefault(view.name, (view, []))[1]
            cur.extend(f for f in fs if f not in cur)
        for rs in o.request_sources():
            spine = rs.check(spine)
    plan = FeaturePlan(spine, list(needed.values()), odfvs, {(v.name, f) for v, fs in views for f in fs}, full_feature_names)
    names = [plan.prefix(v) + f for v, fs in plan.views for f in fs]
    if len(set(names)) != len(names):
        raise ValueError("duplicate feature names; use full_feature_names=True")
    return plan


def drop_inputs(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """Without the features that only on-demand views needed."""
    made = {n for o in plan.on_demand for n in o.feature_names}
    drop = [f for v, fs in plan.views for f in fs if (v.name, f) not in plan.selected and f not in made]
    return df if plan.full_feature_names else df.drop(*drop)


def get_historical_features(spine: DataFrame, items: list, *, spine_ts: str = "event_timestamp",
                            spark=None, project=None, full_feature_names: bool = False, ranges: int | None = None) -> DataFrame:
    """Fold the as-of join over every referenced view, then K5.

    Inputs that an on-demand view needs are fetched even when not selected
    and dropped afterwards. Duplicate output names are an error.
    """
    plan = features_needed(items, spine, project, full_feature_names)
    df = plan.spine
    for view, fs in plan.views:
        src, prefix = view.batch_source, plan.prefix(view)
        df = as_of_join(df, _view_frame(view, spark), view.join_keys, spine_ts=spine_ts, feature_ts=src.timestamp_field,
                        features=fs, ttl=view.ttl, created=src.created_timestamp_column, prefix=prefix, ranges=ranges)
        # Cast to the declared type, batch and online alike.
        types = {f.name: f.spark_type for f in view.schema}
        df = df.withColumns({prefix + f: F.col(prefix + f).cast(types[f]) for f in fs if f in types})
    for o in plan.on_demand:
        df = o.apply(df)
    return drop_inputs(df, plan)


def batch_scoring_spine(entities: DataFrame, ts_col: str = "event_timestamp", now: Column | None = None) -> DataFrame:
    """Every spine time becomes "now", so retrieval returns the newest row within ttl."""
    return entities.withColumn(ts_col, now if now is not None else F.current_timestamp())
