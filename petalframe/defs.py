"""Feature-table definitions (K1): entities, sources, views, services, labels.

Plain dataclasses, validated when they are built. They hold names and types
only; every operator that uses them builds an ordinary Spark plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dtype(d) -> T.DataType:
    if isinstance(d, T.DataType):
        return d
    return T.DataType.fromDDL(d)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: object = "double"
    description: str = ""

    @property
    def spark_type(self) -> T.DataType:
        return _dtype(self.dtype)


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "join_keys", tuple(self.join_keys))
        if not self.join_keys:
            raise ValueError(f"entity {self.name!r} needs at least one join key")


@dataclass
class BatchSource:
    """Time-series source (S6): rows keyed by (entity, event time, created time).

    Either ``path`` (parquet) or ``frame`` (a DataFrame, or a function of the
    session returning one) gives the rows.
    """

    name: str
    timestamp_field: str = "event_timestamp"
    created_timestamp_column: str | None = None
    path: str | None = None
    frame: object = None

    def load(self, spark: SparkSession | None = None) -> DataFrame:
        if self.frame is not None:
            df = self.frame(spark) if callable(self.frame) else self.frame
        elif self.path is not None:
            if spark is None:
                raise ValueError("a session is needed to read a path")
            df = spark.read.parquet(self.path)
        else:
            raise ValueError(f"source {self.name!r} has neither path nor frame")
        for c in (self.timestamp_field, self.created_timestamp_column):
            if c is None:
                continue
            if c not in df.columns:
                raise ValueError(f"source {self.name!r}: time column {c!r} missing")
            dt = df.schema[c].dataType
            if not isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
                raise TypeError(f"source {self.name!r}: {c!r} is {dt.simpleString()}, not a timestamp")
        return df


@dataclass
class PushSource:
    """Events with the batch source's schema, arriving as a stream."""

    name: str
    batch_source: BatchSource


@dataclass
class RequestSource:
    """Columns that only arrive with the request / spine."""

    name: str
    schema: list

    def check(self, df: DataFrame) -> DataFrame:
        missing = [f.name for f in self.schema if f.name not in df.columns]
        if missing:
            raise ValueError(f"request source {self.name!r}: spine lacks {missing}")
        return df.withColumns({f.name: F.col(f.name).cast(f.spark_type) for f in self.schema})


@dataclass
class FeatureView:
    """``enable_validation``: rows that an online store takes in are checked against
    the schema (K6); rejects go to the view's ``_rejects`` folder."""

    name: str
    entities: list
    schema: list
    source: object
    ttl: timedelta | None = None
    online: bool = True
    tags: dict = field(default_factory=dict)
    version: str = "latest"
    description: str = ""
    enable_validation: bool = False

    def __post_init__(self):
        names = [f.name for f in self.schema]
        if len(set(names)) != len(names):
            raise ValueError(f"view {self.name!r}: duplicate feature names")

    @property
    def join_keys(self) -> list:
        keys = []
        for e in self.entities:
            keys.extend(e.join_keys)
        return keys

    @property
    def feature_names(self) -> list:
        return [f.name for f in self.schema]

    @property
    def batch_source(self) -> BatchSource:
        return self.source.batch_source if isinstance(self.source, PushSource) else self.source

    def __getitem__(self, names) -> "FeatureViewProjection":
        names = [names] if isinstance(names, str) else list(names)
        unknown = set(names) - set(self.feature_names)
        if unknown:
            raise KeyError(f"view {self.name!r} has no features {sorted(unknown)}")
        return FeatureViewProjection(self, names)


@dataclass
class FeatureViewProjection:
    view: FeatureView
    features: list


class _Inputs:
    """Column accessor handed to on-demand functions."""

    def __getitem__(self, name: str) -> Column:
        return F.col(name)


@dataclass
class OnDemandFeatureView:
    """Derived features computed from other views and request columns (K5).

    ``fn`` maps an input accessor to ``{name: Column}``; the result is cast to
    the declared schema. With ``mode="pandas"`` ``fn`` takes and returns a
    pandas DataFrame and runs Arrow-batched through ``mapInPandas``.
    """

    name: str
    sources: list
    schema: list
    fn: Callable
    mode: str = "columns"

    @property
    def feature_names(self) -> list:
        return [f.name for f in self.schema]

    def input_views(self) -> list:
        return [s for s in self.sources if isinstance(s, (FeatureView, FeatureViewProjection))]

    def request_sources(self) -> list:
        return [s for s in self.sources if isinstance(s, RequestSource)]

    def apply(self, df: DataFrame) -> DataFrame:
        if self.mode == "pandas":
            return _apply_pandas(self, df)
        exprs = self.fn(_Inputs())
        missing = set(self.feature_names) - set(exprs)
        if missing:
            raise ValueError(f"on-demand view {self.name!r} did not produce {sorted(missing)}")
        return df.withColumns({f.name: exprs[f.name].cast(f.spark_type) for f in self.schema})


def _apply_pandas(odfv: OnDemandFeatureView, df: DataFrame) -> DataFrame:
    out_schema = T.StructType(list(df.schema.fields) + [
        T.StructField(f.name, f.spark_type, True) for f in odfv.schema])
    names = odfv.feature_names

    def run(batches):
        for pdf in batches:
            res = odfv.fn(pdf)
            for n in names:
                pdf[n] = res[n]
            yield pdf

    return df.mapInPandas(run, out_schema)


def on_demand_feature_view(sources: list, schema: list, name: str | None = None, mode: str = "columns"):
    """Decorator form of :class:`OnDemandFeatureView`."""

    def wrap(fn):
        return OnDemandFeatureView(name or fn.__name__, sources, schema, fn, mode)

    return wrap


@dataclass
class FeatureService:
    """``logging_path``: what online retrieval serves is appended there."""

    name: str
    features: list
    logging_path: str | None = None


@dataclass
class LabelView:
    name: str
    entities: list
    schema: list
    source: object
    labeler_field: str = "labeler"
    conflict_policy: str = "LAST_WRITE_WINS"
    allowed_values: dict = field(default_factory=dict)
    tags: dict = field(default_factory=dict)
    description: str = ""

    def __post_init__(self):
        if self.conflict_policy != "LAST_WRITE_WINS":
            raise ValueError("only LAST_WRITE_WINS is supported")
        # "label-values:<field>" tags name the allowed values, comma separated.
        for k, v in self.tags.items():
            if "label-values:" in k:
                fld = k.split("label-values:", 1)[1]
                self.allowed_values.setdefault(fld, [x.strip() for x in str(v).split(",")])

    @property
    def join_keys(self) -> list:
        keys = []
        for e in self.entities:
            keys.extend(e.join_keys)
        return keys

    @property
    def feature_names(self) -> list:
        return [f.name for f in self.schema]


@dataclass
class Project:
    """Registry of named definitions; names must be unique per kind."""

    name: str
    description: str = ""
    objects: dict = field(default_factory=dict)

    def apply(self, objs: Iterable) -> "Project":
        for o in objs:
            kind = type(o).__name__
            key = (kind if kind != "OnDemandFeatureView" else "FeatureView", o.name)
            if key in self.objects and self.objects[key] is not o:
                raise ValueError(f"{kind} {o.name!r} is defined twice")
            self.objects[key] = o
        return self

    def get(self, kind: str, name: str):
        return self.objects[(kind, name)]
