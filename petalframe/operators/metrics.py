"""Classification metrics, overall and by group: A11-A16, X2.

Everything starts from the confusion counts, ``groupBy(group, truth,
pred).count()`` - a partial + final hash aggregate whose output has at most
groups x classes^2 rows, however many scored rows come in. All metrics are
then computed on that small frame in one more aggregate.

Label set per group = labels seen in truth or prediction of that group.
Undefined ratios (no predicted / no true rows of a label) count as 0.
A row without truth or prediction counts and is wrong; a missing value is a
label of its own that is never right, as in the oracle SQL.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs) -> list:
    return [cs] if isinstance(cs, str) else list(cs or [])


def confusion(df: DataFrame, truth: str, pred: str, group=None, weight: str | None = None) -> DataFrame:
    """``(group..., truth, pred, n)``; ``weight`` sums a count column of
    an already aggregated frame instead of counting rows."""
    g = _cols(group)
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    return (df.groupBy(*g, F.col(truth).alias("_truth"), F.col(pred).alias("_pred"))
            .agg(n.alias("_n")))


def label_stats(conf: DataFrame, group=None) -> DataFrame:
    """Per (group, label): true positives, true support, predicted support."""
    g = _cols(group)
    # each count row counts once for its true label and once for its
    # predicted label: one explode, so the confusion frame is read once
    zero = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("_truth").alias("_label"), F.col("_n").alias("_nt"),
                 F.when(F.col("_truth") == F.col("_pred"), F.col("_n")).otherwise(zero).alias("_tp"),
                 zero.alias("_np")),
        F.struct(F.col("_pred").alias("_label"), zero.alias("_nt"), zero.alias("_tp"), F.col("_n").alias("_np")))
    s = (conf.select(*g, F.explode(roles).alias("_r")).select(*g, "_r.*").groupBy(*g, "_label")
         .agg(F.sum("_tp").alias("_tp"), F.sum("_nt").alias("_nt"), F.sum("_np").alias("_np")))
    prec = F.when(F.col("_np") > 0, F.col("_tp") / F.col("_np")).otherwise(F.lit(0.0))
    rec = F.when(F.col("_nt") > 0, F.col("_tp") / F.col("_nt")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("_p") + F.col("_r") > 0,
                2 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(F.lit(0.0))
    return s.withColumn("_p", prec).withColumn("_r", rec).withColumn("_f1", f1)


def _weighted(c: str) -> Column:
    return F.sum(F.col("_nt") * F.col(c)) / F.sum("_nt")


# Metric name -> aggregate expression over the per-label frame.
METRICS: dict[str, Callable[[], Column]] = {
    "accuracy": lambda: F.sum("_tp") / F.sum("_nt"),
    "precision_macro": lambda: F.avg("_p"),
    "recall_macro": lambda: F.avg("_r"),
    "f1_macro": lambda: F.avg("_f1"),
    "precision_weighted": lambda: _weighted("_p"),
    "recall_weighted": lambda: _weighted("_r"),
    "f1_weighted": lambda: _weighted("_f1"),
    "count": lambda: F.sum("_nt"),
}


def classification_metrics(df: DataFrame, truth: str, pred: str, group=None,
                           metrics: dict | None = None, digits: int | None = 10,
                           weight: str | None = None) -> DataFrame:
    """One row per group with the requested metrics.

    ``metrics`` maps output names to keys of :data:`METRICS` (or to callables
    returning an aggregate Column over the per-label frame).
    """
    g = _cols(group)
    metrics = metrics or {"accuracy": "accuracy", "precision": "precision_macro",
                          "recall": "recall_macro", "f1": "f1_macro"}
    stats = label_stats(confusion(df, truth, pred, g, weight), g)
    aggs = []
    for out, m in metrics.items():
        e = (METRICS[m] if isinstance(m, str) else m)()
        if digits is not None and m != "count":
            e = F.round(e, digits)
        aggs.append(e.alias(out))
    return stats.groupBy(*g).agg(*aggs) if g else stats.agg(*aggs)


def group_difference(by_group: DataFrame, metric_cols: list, digits: int | None = 10) -> DataFrame:
    """``max - min`` over groups, per metric (long format)."""
    aggs = [(F.max(c) - F.min(c)).alias(c) for c in metric_cols]
    wide = by_group.agg(*aggs)
    long = wide.unpivot([], metric_cols, "metric", "difference")
    if digits is not None:
        long = long.withColumn("difference", F.round("difference", digits))
    return long


def custom_metric(df: DataFrame, truth: str, pred: str, group, fn: Callable, name: str) -> DataFrame:
    """X2 for metrics with no expression form: ``fn(counts)`` gets one group's
    confusion counts as a pandas frame (``truth, pred, n``; at most classes^2
    rows) and returns a float. Runs with ``applyInPandas`` on the counts, so a
    group never ships its raw rows."""
    import pandas as pd

    g = _cols(group)
    conf = confusion(df, truth, pred, g)
    if not g:
        conf = conf.withColumn("_g0", F.lit(0))
    keys = g or ["_g0"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {c: [pdf[c].iloc[0]] for c in keys}
        counts = pdf.rename(columns={"_truth": "truth", "_pred": "pred", "_n": "n"})[["truth", "pred", "n"]]
        out[name] = [float(fn(counts))]
        return pd.DataFrame(out)

    schema = ", ".join([f"`{c}` {conf.schema[c].dataType.simpleString()}" for c in keys] + [f"`{name}` double"])
    res = conf.groupBy(*keys).applyInPandas(run, schema)
    return res if g else res.drop("_g0")


def quality_gate(metrics_row: DataFrame, gates: list) -> DataFrame:
    """``gates`` = [(name, metric column, op, threshold)]; one row per gate,
    from one pass over the metrics row."""
    items = []
    for name, col, op, thr in gates:
        v = F.col(col).cast("double")
        ok = {">=": v >= thr, ">": v > thr, "<=": v <= thr, "<": v < thr}[op]
        items.append(F.struct(F.lit(name).alias("gate"), v.alias("value"),
                              F.lit(float(thr)).alias("threshold"), F.lit(op).alias("op"),
                              F.coalesce(ok, F.lit(False)).alias("passed")))
    return metrics_row.select(F.explode(F.array(*items)).alias("_g")).select("_g.*")
