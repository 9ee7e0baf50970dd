"""Model queries: run table over poisoned copies (R6 x runs, M7, M8, A1) and
Spark ML fits on ``embeddings`` (M2-M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.functions.rand import sql_hash_rank, sql_uniform
from petalframe.operators import metrics as M
from petalframe.operators import models, sampling
from petalframe.operators.tree_fit import exact_grid, fit_exact_tree
from petalframe.operators.treeshap import predict
from petalframe.plans.q_metrics import MIN_CHARS, _MACRO, metrics_sql
from petalframe.plans.registry import register
from petalframe.session import materialize, work_dir
from petalframe.sources.io import Tables

LEVELS = (0, 5, 10, 50)
REPEATS = (42, 142)  # base seeds; the run seed is base + level
RUNS = [(i + 1, lv, base + lv) for i, (base, lv) in enumerate((b, lv) for b in REPEATS for lv in LEVELS)]
EXPERIMENT = "doc_quality_poisoning"
PARAMS = ["poisoning_level", "seed", "training_samples", "poisoned_samples"]
METRIC_NAMES = ["accuracy", "precision", "recall", "f1"]


def run_metrics(spark, sf_dir):
    """One row per run: poison the labelled documents (feature n_chars, label
    quality), score with the length rule, macro metrics per run - all runs in
    one job."""
    t = Tables(spark, sf_dir)
    d = t.labels.select("doc_id", "quality").join(t.documents.select("doc_id", "n_chars"), "doc_id")
    p = sampling.poison_runs(d, "doc_id", ["n_chars"], "quality", RUNS)
    scored = p.select("run_id", "poisoning_level", "seed", "is_poisoned", F.col("quality").alias("truth"),
                      (F.col("n_chars") >= MIN_CHARS).cast("int").alias("pred"))
    keys = ["run_id", "poisoning_level", "seed"]
    # one grouped pass over the scored rows feeds both the metrics and the counts
    # (runs x classes^2 rows), written once: both branches below read it
    agg = materialize(scored.groupBy(*keys, "truth", "pred").agg(F.count(F.lit(1)).alias("_w"),
                                                                  F.sum("is_poisoned").alias("_pz")), "confusion")
    m = M.classification_metrics(agg, "truth", "pred", keys, weight="_w")
    counts = agg.groupBy(*keys).agg(F.sum("_w").alias("training_samples"),
                                    F.sum("_pz").alias("poisoned_samples"))
    return m.join(counts, keys)


def run_table(spark, sf_dir):
    return models.run_log(run_metrics(spark, sf_dir), EXPERIMENT, PARAMS, METRIC_NAMES)


_RUNS_SQL = ", ".join(f"({r}, {lv}, {sd})" for r, lv, sd in RUNS)
_U_FEAT = sql_uniform(0, "feat:n_chars", "doc_id", seed_sql="seed")
_U_LAB = sql_uniform(0, "label", "doc_id", seed_sql="seed")
_POISON_SCORED = f"""runs AS (SELECT * FROM (VALUES {_RUNS_SQL}) r(run_id, poisoning_level, seed)),
d AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
st AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi, list_sort(list(DISTINCT quality)) AS cls FROM d),
x AS (SELECT r.run_id, r.poisoning_level, r.seed, d.*,
             row_number() OVER (PARTITION BY r.run_id ORDER BY {sql_hash_rank(0, 'pick', 'd.doc_id', seed_sql='r.seed')}, d.doc_id) AS rn,
             count(*) OVER (PARTITION BY r.run_id) AS n
      FROM runs r CROSS JOIN d),
p AS (SELECT x.*, st.lo, st.hi, st.cls,
             x.rn <= round_even(x.n * CAST(x.poisoning_level AS DOUBLE) / 100, 0) AS pz FROM x CROSS JOIN st),
q AS (SELECT run_id, poisoning_level, seed, CAST(pz AS INTEGER) AS is_poisoned,
             CASE WHEN pz THEN CAST(floor(lo + {_U_FEAT} * (hi - lo)) AS BIGINT) ELSE n_chars END AS n_chars,
             CASE WHEN pz THEN list_filter(cls, lambda c: c <> quality)[CAST(floor({_U_LAB} * (len(cls) - 1)) AS INTEGER) + 1]
                  ELSE quality END AS truth FROM p),
s AS (SELECT run_id, poisoning_level, seed, is_poisoned, truth, CAST(n_chars >= {MIN_CHARS} AS INTEGER) AS pred FROM q)"""

_RUN_METRICS_SQL = f"""
WITH m AS ({metrics_sql(_MACRO, ["run_id", "poisoning_level", "seed"], scored=_POISON_SCORED)}),
c AS (WITH {_POISON_SCORED} SELECT run_id, count(*) AS training_samples, sum(is_poisoned) AS poisoned_samples
      FROM s GROUP BY run_id)
SELECT m.*, c.training_samples, c.poisoned_samples FROM m JOIN c USING (run_id)"""

_RUN_LOG_SQL = f"""
WITH rm AS ({_RUN_METRICS_SQL})
SELECT '{EXPERIMENT}' AS experiment, CAST(run_id AS VARCHAR) AS run_id, CAST(run_id AS BIGINT) AS version,
       kind, key, value FROM (
  {" UNION ALL ".join(f"SELECT run_id, 'param' AS kind, '{k}' AS key, CAST({k} AS DOUBLE) AS value FROM rm" for k in PARAMS)}
  UNION ALL
  {" UNION ALL ".join(f"SELECT run_id, 'metric', '{k}', CAST({k} AS DOUBLE) FROM rm" for k in METRIC_NAMES)})"""


@register("run_log", _RUN_LOG_SQL)
def run_log(spark, sf_dir):
    """M7: long run table (params and metrics of 8 poisoning runs)."""
    return run_table(spark, sf_dir)


@register("run_log_sink", _RUN_LOG_SQL)
def run_log_sink(spark, sf_dir):
    """M7: the run table appended to its sink, half of its runs a second time, read back."""
    path = work_dir(spark, "run-log")
    log = materialize(run_table(spark, sf_dir), "runs")
    models.append_runs(log, path)
    models.append_runs(log.where(F.col("version") % 2 == 0), path)
    return models.read_runs(spark, path)


@register("metric_summary_by_level", f"""
WITH l AS ({_RUN_LOG_SQL}),
w AS (SELECT run_id, max(CASE WHEN key = 'poisoning_level' THEN value END) AS poisoning_level,
             {", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in METRIC_NAMES)}
      FROM l GROUP BY run_id)
SELECT CAST(poisoning_level AS INTEGER) AS poisoning_level,
       {", ".join(f"round(avg({k}), 10) AS {k}" for k in METRIC_NAMES)}
FROM w GROUP BY poisoning_level
""")
def metric_summary_by_level(spark, sf_dir):
    """A1: mean of each metric per poisoning level, from the run table."""
    wide = models.run_compare(run_table(spark, sf_dir), ["poisoning_level"] + METRIC_NAMES)
    return (wide.groupBy(F.col("poisoning_level").cast("int").alias("poisoning_level"))
            .agg(*[F.round(F.avg(k), 10).alias(k) for k in METRIC_NAMES])
            .orderBy("poisoning_level"))


@register("run_compare", f"""
WITH l AS ({_RUN_LOG_SQL})
SELECT experiment, run_id, version,
       {", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in ["poisoning_level"] + METRIC_NAMES)}
FROM l GROUP BY experiment, run_id, version
""")
def run_compare(spark, sf_dir):
    """M8: pivot of the run table, one row per run."""
    return models.run_compare(run_table(spark, sf_dir), ["poisoning_level"] + METRIC_NAMES)


@register("latest_model", f"""
WITH l AS ({_RUN_LOG_SQL})
SELECT experiment, arg_max(run_id, version) AS run_id, max(version) AS version,
       arg_max(value, version) AS accuracy
FROM l WHERE key = 'accuracy' GROUP BY experiment
""")
def latest_model(spark, sf_dir):
    """Newest run per experiment and its accuracy."""
    return models.latest_run(run_table(spark, sf_dir), "accuracy")


# ---------------------------------------------------------- Spark ML fits

DIMS = 64


def _split_embeddings(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    s = sampling.stratified_split(e, "vec_id", "label", 0.2, 42)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


@register("logreg_score")
def logreg_score(spark, sf_dir):
    """M1+M2+M6: standardise, multinomial logistic regression, score the test split."""
    train, test = _split_embeddings(spark, sf_dir)
    m = models.fit_logistic(train, "embedding", "label", C=1.0, dims=DIMS)
    return m.transform(test.select("vec_id", "label", "embedding")).select("vec_id", "label", "prediction")


@register("tree_grid")
def tree_grid(spark, sf_dir):
    """M3+M4: depth {2,3,4} x {gini, entropy}; one metrics row per run."""
    train, test = _split_embeddings(spark, sf_dir)
    return models.tree_grid(train.select("label", "embedding"), test.select("label", "embedding"),
                            "embedding", "label")


@register("poison_sweep")
def poison_sweep(spark, sf_dir):
    """M5: poison the training split at 0/5/10/50 %, fit scaler + logistic per
    level, evaluate all levels on the clean test split in one aggregate."""
    train, test = _split_embeddings(spark, sf_dir)
    runs = [(i + 1, lv, 42 + lv) for i, lv in enumerate(LEVELS)]
    clean = train.select("vec_id", "label", "embedding").cache()
    poisoned = sampling.poison_runs(clean, "vec_id", [], "label", runs, array_feature="embedding").cache()
    labels = models.class_labels(clean, "label")
    fitted = models.fit_parallel(
        [lambda r=r: models.fit_logistic(poisoned.where(F.col("run_id") == r), "embedding", "label", dims=DIMS, labels=labels)
         for r, _, _ in runs], parallelism=len(runs))
    scored = models.score_all(test.select("label", "embedding"), {lv: m for (_, lv, _), m in zip(runs, fitted)}, ["label"], "poisoning_level")
    # the fits are done: only the models are needed from here
    poisoned.unpersist()
    clean.unpersist()
    return M.classification_metrics(scored, "label", "prediction", ["poisoning_level"]).orderBy("poisoning_level")


_SIZES = """SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price,
  CASE WHEN p_size <= 10 THEN 'small' WHEN p_size BETWEEN 21 AND 30 THEN 'medium' WHEN p_size >= 41 THEN 'large' END AS kind
  FROM part WHERE p_size <= 10 OR p_size BETWEEN 21 AND 30 OR p_size >= 41"""


def _sized_parts(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    kind = F.when(F.col("p_size") <= 10, "small").when(F.col("p_size").between(21, 30), "medium").when(F.col("p_size") >= 41, "large")
    return p.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"), kind.alias("kind")).where(
        "kind IS NOT NULL")


@register("logreg_string_labels", f"SELECT p_partkey, kind, kind AS prediction FROM ({_SIZES})")
def logreg_string_labels(spark, sf_dir):
    """Classes that part by a wide margin, labelled by name: fitted with
    the scaler, saved as two versions, the newest loaded, every part scored."""
    parts, base = _sized_parts(spark, sf_dir), work_dir(spark, "model")
    models.save_version(models.fit_logistic(parts, ["price"], "kind"), base)
    models.save_version(models.fit_logistic(parts, ["size", "price"], "kind", C=100.0), base)
    return models.load_newest(spark, base).transform(parts).select("p_partkey", "kind", "prediction")


_CUT_SCORE = {
    "gini": "sum(l * l) / any_value(nl) + sum((t - l) * (t - l)) / (any_value(nt) - any_value(nl))",
    "entropy": "sum(CASE WHEN l > 0 THEN l * ln(l / nl) ELSE 0 END) + sum(CASE WHEN t > l THEN (t - l) * ln((t - l) / (nt - nl)) ELSE 0 END)"}


def _greedy_ctes(depth: int, impurity: str, p: str) -> str:
    """Greedy splits of customers' segments by nation and balance, level by level:
    ``<p>n<level>`` holds the node of every customer."""
    out = f"""{p}n0 AS (SELECT c_custkey, c_mktsegment AS y, CAST(c_nationkey AS DOUBLE) AS x0, c_acctbal AS x1, CAST(1 AS INTEGER) AS node FROM customer)"""
    for k in range(depth):
        out += f""",
{p}v{k} AS (SELECT node, f, x, y, count(*) AS c FROM (SELECT node, 0 AS f, x0 AS x, y FROM {p}n{k} UNION ALL SELECT node, 1, x1, y FROM {p}n{k}) GROUP BY ALL),
{p}g{k} AS (SELECT a.node, a.f, a.x, b.y, coalesce(v.c, 0) AS c
  FROM (SELECT DISTINCT node, f, x FROM {p}v{k}) a JOIN (SELECT DISTINCT node, y FROM {p}v{k}) b ON a.node = b.node
  LEFT JOIN {p}v{k} v ON v.node = a.node AND v.f = a.f AND v.x = a.x AND v.y = b.y),
{p}c{k} AS (SELECT *, sum(c) OVER (PARTITION BY node, f, y ORDER BY x) AS l, sum(c) OVER (PARTITION BY node, f, y) AS t FROM {p}g{k}),
{p}w{k} AS (SELECT *, sum(l) OVER (PARTITION BY node, f, x) AS nl, sum(t) OVER (PARTITION BY node, f, x) AS nt FROM {p}c{k}),
{p}s{k} AS (SELECT node, f, x, any_value(nt) AS nt, sum(t * t) AS st, {_CUT_SCORE[impurity]} AS score FROM {p}w{k} GROUP BY node, f, x),
{p}q{k} AS (SELECT *, lead(x) OVER (PARTITION BY node, f ORDER BY x) AS nx FROM {p}s{k}),
{p}b{k} AS (SELECT node, f, (x + nx) / 2 AS threshold FROM {p}q{k} WHERE nx IS NOT NULL AND st < nt * nt
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(score / nt, 9) DESC, f, x) = 1),
{p}n{k + 1} AS (SELECT c_custkey, y, x0, x1, CAST(CASE WHEN f IS NULL THEN n.node WHEN CASE WHEN f = 0 THEN x0 ELSE x1 END <= threshold THEN 2 * n.node
  ELSE 2 * n.node + 1 END AS INTEGER) AS node FROM {p}n{k} n LEFT JOIN {p}b{k} b ON n.node = b.node)"""
    return out


def _leaf_labels(table: str) -> str:
    return f"(SELECT node, y FROM {table} GROUP BY node, y QUALIFY row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, y) = 1)"


@register("tree_exact", f"""WITH {_greedy_ctes(3, "gini", "")}
SELECT c_custkey, n.node AS leaf, m.y AS prediction FROM n3 n JOIN {_leaf_labels("n3")} m ON n.node = m.node""")
def tree_exact(spark, sf_dir):
    """M3/M6: a tree of depth 3 with exact thresholds on string classes; leaf and label of every customer."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    tree = fit_exact_tree(c, ["c_nationkey", "c_acctbal"], "c_mktsegment", max_depth=3)
    return predict(c, tree).select("c_custkey", "leaf", "prediction")


_GRID = [(i + 1, d, c) for i, (d, c) in enumerate((d, c) for d in (2, 3) for c in ("gini", "entropy"))]


@register("tree_grid_exact", metrics_sql(_MACRO, ["run_id", "max_depth", "criterion"], scored=", ".join(
    [_greedy_ctes(3, "gini", "gini_"), _greedy_ctes(3, "entropy", "entropy_"), "s AS (" + " UNION ALL ".join(
        f"SELECT {r} AS run_id, {d} AS max_depth, '{c}' AS criterion, n.y AS truth, m.y AS pred "
        f"FROM {c}_n{d} n JOIN {_leaf_labels(f'{c}_n{d}')} m ON n.node = m.node" for r, d, c in _GRID) + ")"])))
def tree_grid_exact(spark, sf_dir):
    """M3/M4: depth {2, 3} x {gini, entropy} with exact thresholds; macro metrics on the rows fitted."""
    c = Tables(spark, sf_dir).customer.select("c_nationkey", "c_acctbal", "c_mktsegment")
    return exact_grid(c, c, ["c_nationkey", "c_acctbal"], "c_mktsegment")
