"""Training, scoring and run tables: M1-M8.

Learners are Spark ML estimators (distributed fits); features stay named
columns until ``VectorAssembler`` at the model boundary. Metrics of every
run come from :mod:`petalframe.operators.metrics` over the scored rows of
all runs at once (one grouped aggregate keyed by run).

Logistic regression matches an L2-penalised multinomial objective
``C * sum(loss) + 0.5 * |w|^2`` with ``regParam = 1 / (C * n)`` on features
standardised by the population deviation (M1), intercept unpenalised,
``standardization=False`` because M1 already scaled.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petalframe.operators import checks, metrics


@dataclass
class FittedModel:
    """A model with all that scoring needs: features, scaler and, for every class
    index, the label it stands for (in the label column's own type)."""

    kind: str
    model: object
    features: list | str
    scaler: dict | None = None
    params: dict | None = None
    labels: list | None = None
    label_type: str = "int"

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Batch scoring; the prediction is a label again, of the label's type."""
        x = _assemble(df, self.features, self.scaler)
        out = self.model.transform(x).withColumnRenamed("prediction", "_prediction")
        keep = [c for c in df.columns] + ["_prediction"]
        at = F.col("_prediction").cast("int")
        label = at if self.labels is None else F.element_at(F.array(*[F.lit(v) for v in self.labels]), at + 1)
        return out.select(*keep).withColumn(prediction, label.cast(self.label_type)).drop("_prediction")


def class_labels(df: DataFrame, label: str) -> list:
    """The sorted labels of ``df``; a class's place is its index (one value per class, as any model holds)."""
    return [r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label).collect()]


def class_index(label: str, labels: list) -> Column:
    """Index of a row's label as double; NULL for NULL and for labels not listed."""
    at = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)) - 1
    return F.when(at >= 0, at.cast("double"))


def _assemble(df: DataFrame, features, scaler: dict | None) -> DataFrame:
    from pyspark.ml.linalg import VectorUDT

    if isinstance(features, str) and isinstance(df.schema[features].dataType, VectorUDT):
        return df if features == "features" else df.withColumn("features", F.col(features))
    if isinstance(features, str):  # one array column
        col = F.col(features)
        if scaler:
            mean, std = scaler[features]
            col = F.transform(col, lambda x, i: (x - F.element_at(F.array(*map(F.lit, mean)), i + 1))
                              / F.element_at(F.array(*map(F.lit, std)), i + 1))
        return df.withColumn("features", array_to_vector(col.cast("array<double>")))
    x = checks.standard_scaler_transform(df, scaler, suffix="__z") if scaler else df
    cols = [c + "__z" for c in features] if scaler else list(features)
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error").transform(x)


def fit_array_scaler(df: DataFrame, col: str, dims: int | None = None) -> dict:
    """M1 for an array column: per-position population mean / deviation from
    one vector aggregate (``Summarizer``); zero deviation scales by 1."""
    from pyspark.ml.stat import Summarizer

    s = (df.select(array_to_vector(F.col(col).cast("array<double>")).alias("_v"))
         .select(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s")).first()["s"])
    n = s["count"]
    mean = list(s["mean"])
    # Summarizer's variance is the sample variance; the scaler uses the population one
    std = [((v * (n - 1) / n) ** 0.5 if n > 0 else 0.0) or 1.0 for v in s["variance"]]
    return {col: (mean, std)}


ROWS_PER_PARTITION = 200_000


def sized_for_iterations(x: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION):
    """Cache training rows in partitions sized by row count.

    Iterative learners pass over the rows once per iteration; the partition
    count should follow the data (thousands of partitions at scale, one for a
    few hundred rows), not whatever an earlier shuffle left behind. The rows
    are computed once (cache + count); only a partition count far from the
    target is changed afterwards, from the cached rows (``coalesce`` when
    there are too many - narrow - and a repartition when too few).
    """
    x = x.cache()
    n = x.count()
    parts = max(1, -(-n // rows_per_partition))
    have = x.rdd.getNumPartitions()
    if have > 2 * parts or 2 * have < parts:
        y = (x.coalesce(parts) if have > parts else x.repartition(parts)).cache()
        y.count()
        x.unpersist()
        x = y
    return x, n


def fit_logistic(train: DataFrame, features, label: str, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-6,
                 dims: int | None = None, labels: list | None = None) -> FittedModel:
    """M1 + M2. The label column may have any type; rows without a label play no
    part. ``labels``: the classes, where they are known (else one distinct pass)."""
    train, labels = train.where(F.col(label).isNotNull()), labels or class_labels(train, label)
    scaler = (fit_array_scaler(train, features, dims) if isinstance(features, str)
              else checks.standard_scaler_fit(train, features))
    # The optimiser passes over the rows once per iteration: keep only the
    # assembled vectors and labels, cached, instead of re-running the lineage.
    x = _assemble(train, features, scaler).select("features", class_index(label, labels).alias("_label"))
    x, n = sized_for_iterations(x)
    lr = LogisticRegression(featuresCol="features", labelCol="_label", family="multinomial",
                            regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=tol)
    model = lr.fit(x)
    x.unpersist()
    return FittedModel("logistic", model, features, scaler, {"C": C, "max_iter": max_iter}, labels, train.schema[label].dataType.simpleString())


def fit_tree(train: DataFrame, features, label: str, max_depth: int = 4, impurity: str = "gini",
             seed: int = 1, max_bins: int = 256, labels: list | None = None) -> FittedModel:
    """M3 with thresholds from ``max_bins`` quantiles a feature; with at least as
    many bins as distinct values they are the midpoints. Exact thresholds
    whatever the values: :func:`petalframe.operators.tree_fit.fit_exact_tree`."""
    train, labels = train.where(F.col(label).isNotNull()), labels or class_labels(train, label)
    x = _assemble(train, features, None).select("features", class_index(label, labels).alias("_label"))
    dt = DecisionTreeClassifier(featuresCol="features", labelCol="_label", maxDepth=max_depth,
                                impurity=impurity, seed=seed, maxBins=max_bins, cacheNodeIds=True)
    return FittedModel("tree", dt.fit(x), features, None,
                       {"max_depth": max_depth, "criterion": impurity, "seed": seed, "max_bins": max_bins}, labels,
                       train.schema[label].dataType.simpleString())


def score_all(df: DataFrame, fitted: dict, keep: list, run: str = "run_id", prediction: str = "prediction") -> DataFrame:
    """``keep`` columns, run and prediction: the rows are read once, scored by every
    model as a column of its own, and the columns turned into rows."""
    out = df
    for r, m in fitted.items():
        out = m.transform(out, f"_p_{r}")
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias(run), F.col(f"_p_{r}").alias(prediction)) for r in fitted]))
    return out.select(*keep, pairs.alias("_s")).select(*keep, "_s.*")


def fit_parallel(fits: list, parallelism: int = 4) -> list:
    """Run independent fits as concurrent Spark jobs (like a parameter grid
    with ``parallelism``): each fit is a distributed job; the scheduler
    interleaves their tasks instead of idling between small stages."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda f: f(), fits))


def evaluate(scored: DataFrame, label: str, run_cols: list, prediction: str = "prediction") -> DataFrame:
    """Macro metrics per run in one grouped aggregate."""
    return metrics.classification_metrics(scored, label, prediction, run_cols)


def tree_grid(train: DataFrame, test: DataFrame, features, label: str, depths=(2, 3, 4), criteria=("gini", "entropy"),
              seed: int = 1, parallelism: int = 3, max_bins: int = 256) -> DataFrame:
    """M4: depth x criterion grid -> one table ``(run_id, max_depth, criterion, metrics...)``.

    Fits run as concurrent jobs over the cached vectors; the test rows are read
    once, scored by all models, and evaluated in one aggregate.
    """
    # assemble once; every fit of the grid reads the cached vectors
    labels = class_labels(train, label)
    train, _ = sized_for_iterations(_assemble(train, features, None).select("features", label))
    grid = [(i + 1, d, c) for i, (d, c) in enumerate((d, c) for d in depths for c in criteria)]
    fitted = fit_parallel([lambda d=d, c=c: fit_tree(train, "features", label, d, c, seed, max_bins, labels) for _, d, c in grid],
                          parallelism)
    for m in fitted:
        m.features = features
    scored = score_all(test.select(label, *([features] if isinstance(features, str) else features)),
                       {run: m for (run, _, _), m in zip(grid, fitted)}, [label])
    named = F.element_at(F.array(*[F.struct(F.lit(d).alias("max_depth"), F.lit(c).alias("criterion")) for _, d, c in grid]), F.col("run_id"))
    out = evaluate(scored.withColumn("_g", named).select(label, "prediction", "run_id", "_g.*"), label, ["run_id", "max_depth", "criterion"])
    train.unpersist()
    return out


def run_log(runs: DataFrame, experiment: str, param_cols: list, metric_cols: list,
            run_col: str = "run_id", version_col: str | None = None) -> DataFrame:
    """M7: long run table ``(experiment, run_id, version, kind, key, value)``."""
    version = F.col(version_col).cast("long") if version_col else F.col(run_col).cast("long")
    ids = ["experiment", "run_id", "version"]
    base = runs.select(F.lit(experiment).alias("experiment"), F.col(run_col).cast("string").alias("run_id"),
                       version.alias("version"),
                       *[F.col(c).cast("double").alias(c) for c in param_cols + metric_cols])
    # one unpivot of params and metrics together: the run frame is computed once
    kind = F.when(F.col("key").isin(*param_cols), F.lit("param")).otherwise(F.lit("metric"))
    long = base.unpivot(ids, param_cols + metric_cols, "key", "value").withColumn("kind", kind)
    return long.select(*ids, "kind", "key", "value")


def append_runs(log: DataFrame, path: str) -> None:
    """M7 sink: add the runs of a long run table to the table at ``path``, one
    folder per (experiment, run). A run that is written again replaces its own
    folder and touches no other, so a retried or repeated job changes nothing."""
    (log.repartition("experiment", "run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment", "run_id").parquet(path))


def read_runs(spark, path: str) -> DataFrame:
    """The run table that :func:`append_runs` writes; experiment and run filters prune folders."""
    schema = "version long, key string, value double, kind string, experiment string, run_id string"
    return spark.read.schema(schema).parquet(path).select("experiment", "run_id", "version", "kind", "key", "value")


def run_compare(log: DataFrame, keys: list) -> DataFrame:
    """M8: pivot the long run table back to one row per run (listed keys)."""
    return (log.where(F.col("key").isin(*keys)).groupBy("experiment", "run_id", "version")
            .pivot("key", keys).agg(F.first("value")))


def latest_run(log: DataFrame, metric: str) -> DataFrame:
    """Per experiment the newest run (highest version) and its metric."""
    return (log.where(F.col("key") == metric).groupBy("experiment")
            .agg(F.max_by("run_id", "version").alias("run_id"), F.max("version").alias("version"),
                 F.max_by("value", "version").alias(metric)))


_KINDS = {"logistic": "LogisticRegressionModel", "tree": "DecisionTreeClassificationModel"}


def save_model(m: FittedModel, path: str) -> None:
    """The fitted model at ``path``, and in ``path/fitted``, written last, what
    scoring needs besides: kind, features, scaler, parameters, labels."""
    m.model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    told = {k: getattr(m, k) for k in ("kind", "features", "scaler", "params", "labels", "label_type")}
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/fitted")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    """A saved model, ready to :meth:`FittedModel.transform`."""
    from pyspark.ml import classification

    told = json.loads(spark.read.text(f"{path.rstrip('/')}/fitted").first()["value"])
    scaler = told["scaler"] and {k: tuple(v) for k, v in told["scaler"].items()}
    return FittedModel(**told | {"model": getattr(classification, _KINDS[told["kind"]]).load(path), "scaler": scaler})


def saved_versions(spark: SparkSession, base: str) -> list:
    """The versions of a model folder that are complete, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [n for n in names if n.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{n}/fitted/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def save_version(m: FittedModel, base: str) -> int:
    """Save as the next version of a model folder."""
    version = max(saved_versions(SparkSession.getActiveSession(), base), default=0) + 1
    save_model(m, f"{base.rstrip('/')}/version={version}")
    return version


def load_newest(spark: SparkSession, base: str) -> FittedModel:
    versions = saved_versions(spark, base)
    if not versions:
        raise RuntimeError(f"no complete model under {base!r}")
    return load_model(spark, f"{base.rstrip('/')}/version={versions[-1]}")


def load_tree(path: str):
    from pyspark.ml.classification import DecisionTreeClassificationModel

    return DecisionTreeClassificationModel.load(path)
