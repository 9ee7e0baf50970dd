"""Scans and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy access to the parquet tables of one folder: ``t.events``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.base}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header row, explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list | None = None) -> DataFrame:
    """The reader prunes to the selected columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: list | None = None, mode: str = "overwrite") -> None:
    """S3."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row; one folder of part files."""
    df.write.mode(mode).option("header", True).csv(path)


class MissingInput(RuntimeError):
    pass


def guarded_load(spark: SparkSession, path: str, step: str, fmt: str = "parquet",
                 schema: T.StructType | str | None = None) -> DataFrame:
    """A missing input names the step that writes it."""
    try:
        r = spark.read.format(fmt)
        if schema is not None:
            r = r.schema(schema)
        if fmt == "csv":
            r = r.option("header", True)
        return r.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingInput(f"{path} not found; run {step!r} first") from e
        raise


def log_served_features(df: DataFrame, path: str, ts_col: str | None = None, served_at=None) -> None:
    """Append served rows with the time they were served (``served_at``: a
    column, default now), partitioned by the day of ``ts_col`` or of that time."""
    df = with_ingest_time(df, "served_at", served_at)
    df.withColumn("log_date", F.to_date(F.col(ts_col or "served_at"))).write.mode("append").partitionBy("log_date").parquet(path)


def read_served_log(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """S9 read back: days from ``start`` to before ``end`` (dates as text); other days are pruned."""
    log = spark.read.parquet(path)
    if start is not None:
        log = log.where(F.col("log_date") >= F.lit(start).cast("date"))
    return log if end is None else log.where(F.col("log_date") < F.lit(end).cast("date"))


def with_ingest_time(df: DataFrame, col: str = "ingest_timestamp", at=None) -> DataFrame:
    """The time the rows were read in, one value for the whole job."""
    return df.withColumn(col, at if at is not None else F.current_timestamp())


def inline_table(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """S10."""
    return spark.createDataFrame(rows, schema)


def run_partition_name(ts_col) -> "F.Column":
    """F8: run folder name ``yyyyMMdd_HHmmss``."""
    return F.date_format(ts_col, "yyyyMMdd_HHmmss")


def latest_partition(df: DataFrame, col: str = "run_ts") -> DataFrame:
    """Rows of the newest run.

    The max is a one-row aggregate; the filter on a partition column is pruned
    by the reader when ``df`` is a partitioned table.
    """
    newest = df.agg(F.max(col).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(col) == F.col("_newest")).drop("_newest")


def read_level(spark: SparkSession, path: str, level: int, col: str = "poisoning_level") -> DataFrame:
    """One member of a parameterised family = partition pruning."""
    return spark.read.parquet(path).where(F.col(col) == level)


def run_metadata(df: DataFrame, split_col: str, seed: int) -> DataFrame:
    """Totals and seed as a one-row table, from one aggregate."""
    return df.agg(F.count(F.lit(1)).cast("int").alias("total_samples"),
                  F.sum(F.when(F.col(split_col) == "train", 1).otherwise(0)).cast("int").alias("training_samples"),
                  F.sum(F.when(F.col(split_col) == "test", 1).otherwise(0)).cast("int").alias("test_samples"),
                  F.lit(seed).cast("int").alias("random_seed"))
