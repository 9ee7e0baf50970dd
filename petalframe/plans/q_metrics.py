"""Model-quality queries: metrics, by-group metrics, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.operators import metrics as M
from petalframe.plans.registry import register
from petalframe.sources.io import Tables

# Fixed rule used as the "model" over the labelled documents.
MIN_CHARS = 1500


def scored_documents(t):
    """Truth = labels.quality, prediction = a length rule, group = language."""
    d = t.documents.select("doc_id", "lang", "n_chars")
    return (t.labels.select("doc_id", "quality").join(d, "doc_id")
            .select("doc_id", "lang", F.col("quality").alias("truth"),
                    (F.col("n_chars") >= MIN_CHARS).cast("int").alias("pred")))


_SCORED = f"""s AS (SELECT d.doc_id, d.lang, l.quality AS truth, CAST(d.n_chars >= {MIN_CHARS} AS INTEGER) AS pred
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def metrics_sql(select: str, group: list, scored: str = _SCORED) -> str:
    """Oracle for :func:`classification_metrics`; ``scored`` is a CTE named ``s``
    with ``truth``, ``pred`` and the group columns (it may be preceded by more CTEs)."""
    g = ", ".join(group)
    gs = (g + ", ") if group else ""
    by = f"GROUP BY {g}" if group else ""
    return f"""
WITH {scored},
conf AS (SELECT {gs}truth, pred, count(*) AS n FROM s GROUP BY ALL),
lab0 AS (SELECT {gs}truth AS label, CASE WHEN truth = pred THEN n ELSE 0 END AS tp, n AS nt, 0 AS np FROM conf
         UNION ALL SELECT {gs}pred AS label, 0, 0, n FROM conf),
lab AS (SELECT {gs}label, sum(tp) AS tp, sum(nt) AS nt, sum(np) AS np FROM lab0 GROUP BY ALL),
m0 AS (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p,
                 CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS r FROM lab),
m AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM m0)
SELECT {gs}{select} FROM m {by}
"""


_MACRO = ("round(sum(tp) / sum(nt), 10) AS accuracy, round(avg(p), 10) AS precision, "
          "round(avg(r), 10) AS recall, round(avg(f1), 10) AS f1")
_WEIGHTED = ("round(sum(tp) / sum(nt), 10) AS accuracy, round(sum(nt * p) / sum(nt), 10) AS precision, "
             "round(sum(nt * r) / sum(nt), 10) AS recall, round(sum(nt * f1) / sum(nt), 10) AS f1")
_WEIGHTED_METRICS = {"accuracy": "accuracy", "precision": "precision_weighted",
                     "recall": "recall_weighted", "f1": "f1_weighted"}


@register("class_metrics_macro", metrics_sql(_MACRO, []))
def class_metrics_macro(spark, sf_dir):
    """Accuracy and macro precision / recall / F1."""
    return M.classification_metrics(scored_documents(Tables(spark, sf_dir)), "truth", "pred")


@register("class_metrics_weighted", metrics_sql(_WEIGHTED, []))
def class_metrics_weighted(spark, sf_dir):
    """Support-weighted precision / recall / F1."""
    return M.classification_metrics(scored_documents(Tables(spark, sf_dir)), "truth", "pred",
                                    metrics=_WEIGHTED_METRICS)


@register("metrics_by_group", metrics_sql(_WEIGHTED + ", CAST(sum(nt) AS BIGINT) AS n_rows", ["lang"]))
def metrics_by_group(spark, sf_dir):
    """The weighted metrics per language, all groups in one pass."""
    return M.classification_metrics(scored_documents(Tables(spark, sf_dir)), "truth", "pred", "lang",
                                    metrics={**_WEIGHTED_METRICS, "n_rows": "count"})


@register("metrics_group_difference", f"""
WITH g AS ({metrics_sql(_WEIGHTED, ["lang"])})
SELECT metric, round(difference, 10) AS difference FROM (
  SELECT 'accuracy' AS metric, max(accuracy) - min(accuracy) AS difference FROM g
  UNION ALL SELECT 'precision', max(precision) - min(precision) FROM g
  UNION ALL SELECT 'recall', max(recall) - min(recall) FROM g
  UNION ALL SELECT 'f1', max(f1) - min(f1) FROM g)
""")
def metrics_group_difference(spark, sf_dir):
    """Between-group difference (max - min) per metric."""
    by = M.classification_metrics(scored_documents(Tables(spark, sf_dir)), "truth", "pred", "lang",
                                  metrics=_WEIGHTED_METRICS)
    return M.group_difference(by, ["accuracy", "precision", "recall", "f1"])


@register("quality_gate", f"""
WITH mm AS ({metrics_sql(_MACRO, [])})
SELECT 'accuracy' AS gate, accuracy AS value, CAST(0.9 AS DOUBLE) AS threshold, '>=' AS op,
       accuracy >= 0.9 AS passed FROM mm
UNION ALL
SELECT 'precision', precision, CAST(0.9 AS DOUBLE), '>', precision > 0.9 FROM mm
""")
def quality_gate(spark, sf_dir):
    """Accuracy >= 0.90 and macro precision > 0.90, one row per gate."""
    m = M.classification_metrics(scored_documents(Tables(spark, sf_dir)), "truth", "pred")
    return M.quality_gate(m, [("accuracy", "accuracy", ">=", 0.9), ("precision", "precision", ">", 0.9)])
