"""Tree scoring as a Column expression, path-dependent Shapley values, report: M6, M9, M10.

A fitted tree is a small table of nodes (read from the saved model's node
parquet, or given literally). From it the driver builds one entry per leaf:
its class shares ``v`` and, per distinct feature on its path, an interval
``(lo, hi]`` and a cover ratio ``z`` (product of child/parent counts of the
splits on that feature). For a row let ``o_d = 1`` when ``x_d`` lies in the
leaf's interval. Each leaf is then a product game over its path features D and
its Shapley value for feature d is

    v * (o_d - z_d) * sum_{S in D \\ {d}} |S|! (|D|-|S|-1)! / |D|!
                                        * prod_{s in S} o_s * prod_{r not in S, r != d} z_r

The factorials are ``integral of y^|S| (1 - y)^(|D|-|S|-1)`` over [0, 1], so the
sum over all subsets is the integral of the polynomial
``prod_{r != d} (o_r y + z_r (1 - y))`` of degree |D| - 1, which Gauss-Legendre
quadrature with ceil(|D| / 2) points gives exactly: |D|^2 steps a leaf and row
instead of 2^|D|, for trees of any size, in Arrow batches. Summing over leaves
gives the tree's values (linearity).

A missing value (NULL or NaN) goes right at every split, in scoring and in the
Shapley values alike: it is larger than any threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows whose values are computed together: bounds the arrays of a batch, not the result.
SLICE_ROWS = 4096


@dataclass
class Node:
    id: int
    counts: list
    left: int | None = None
    right: int | None = None
    feature: str | None = None
    threshold: float | None = None


@dataclass
class Leaf:
    id: int
    value: list  # class shares
    bounds: dict  # feature -> (lo, hi]  (None = unbounded)
    cover: dict  # feature -> product of child/parent count ratios


class Tree:
    def __init__(self, nodes: list, classes: list, features: list):
        self.nodes = {n.id: n for n in nodes}
        self.classes = list(classes)
        self.features = list(features)
        self.root = min(self.nodes)
        self.leaves = self._leaves()

    @classmethod
    def from_spark_model(cls, spark: SparkSession, path: str, features: list, classes: list) -> "Tree":
        """Node table of a saved ``DecisionTreeClassificationModel`` (``path/data``)."""
        rows = spark.read.parquet(f"{path.rstrip('/')}/data").collect()  # O(nodes) rows
        nodes = []
        for r in rows:
            leaf = r["leftChild"] < 0
            stats = list(r["impurityStats"])
            nodes.append(Node(r["id"], stats,
                              None if leaf else r["leftChild"], None if leaf else r["rightChild"],
                              None if leaf else features[r["split"]["featureIndex"]],
                              None if leaf else float(r["split"]["leftCategoriesOrThreshold"][0])))
        return cls(nodes, classes, features)

    def _leaves(self) -> list:
        out = []

        def walk(nid, bounds, cover):
            n = self.nodes[nid]
            if n.left is None:
                tot = float(sum(n.counts))
                out.append(Leaf(nid, [c / tot for c in n.counts], dict(bounds), dict(cover)))
                return
            parent = float(sum(n.counts))
            for child, is_left in ((n.left, True), (n.right, False)):
                lo, hi = bounds.get(n.feature, (None, None))
                if is_left:
                    hi = n.threshold if hi is None else min(hi, n.threshold)
                else:
                    lo = n.threshold if lo is None else max(lo, n.threshold)
                b = dict(bounds)
                b[n.feature] = (lo, hi)
                c = dict(cover)
                c[n.feature] = c.get(n.feature, 1.0) * (sum(self.nodes[child].counts) / parent)
                walk(child, b, c)

        walk(self.root, {}, {})
        return out

    @property
    def base_value(self) -> list:
        root = self.nodes[self.root]
        tot = float(sum(root.counts))
        return [c / tot for c in root.counts]


def leaf_expr(tree: Tree, cols: dict | None = None) -> Column:
    """M6: id of the leaf a row falls into (nested CASE over the splits)."""
    cols = cols or {f: F.col(f) for f in tree.features}

    def build(nid):
        n = tree.nodes[nid]
        if n.left is None:
            return F.lit(nid)
        return F.when(cols[n.feature] <= F.lit(n.threshold), build(n.left)).otherwise(build(n.right))

    return build(tree.root)


def predict(df: DataFrame, tree: Tree, leaf: str = "leaf", prediction: str = "prediction") -> DataFrame:
    """M6: leaf id and predicted class (largest class share, first on ties)."""
    best = {lf.id: tree.classes[max(range(len(lf.value)), key=lambda i: lf.value[i])] for lf in tree.leaves}
    mapping = F.create_map(*[x for k, v in best.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(leaf, leaf_expr(tree)).withColumn(prediction, mapping[F.col(leaf)])


def leaf_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Shapley values ``(rows, classes, features)`` for ``x`` (rows, features)."""
    x = np.where(np.isnan(x), np.inf, x)
    at = {f: i for i, f in enumerate(tree.features)}
    out = np.zeros((len(x), len(tree.classes), len(tree.features)))
    rules = {}
    for leaf in tree.leaves:
        path = list(leaf.bounds)
        if not path:
            continue
        if len(path) not in rules:
            y, w = np.polynomial.legendre.leggauss((len(path) + 1) // 2)
            rules[len(path)] = (y + 1) / 2, w / 2
        y, w = rules[len(path)]
        o = np.empty((len(path), len(x)))
        for i, f in enumerate(path):
            lo, hi = leaf.bounds[f]
            inside = np.ones(len(x), dtype=bool) if lo is None else x[:, at[f]] > lo
            o[i] = inside if hi is None else inside & (x[:, at[f]] <= hi)
        z = np.array([leaf.cover[f] for f in path])
        # before[i], after[i]: products of the factors up to and from feature i, at every point
        factor = o[:, :, None] * y + z[:, None, None] * (1 - y)
        before = np.concatenate([np.ones_like(factor[:1]), np.cumprod(factor[:-1], axis=0)])
        after = np.concatenate([np.cumprod(factor[:0:-1], axis=0)[::-1], np.ones_like(factor[:1])])
        phi = (o - z[:, None]) * ((before * after) @ w)
        for i, f in enumerate(path):
            out[:, :, at[f]] += phi[i][:, None] * np.array(leaf.value)
    return out


def shap_values(df: DataFrame, tree: Tree, keys: list, digits: int | None = 10) -> DataFrame:
    """M9: long table ``(keys..., class, feature, phi)`` for every row, class and
    model feature (features the tree never splits on get 0)."""
    inputs = df.select(*keys, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(tree.features)])
    text = isinstance(tree.classes[0], str)
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("class", T.StringType() if text else T.LongType()),
                           T.StructField("feature", T.StringType()), T.StructField("phi", T.DoubleType())])
    n_class, n_feature = len(tree.classes), len(tree.features)

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(a, SLICE_ROWS)
                x = np.column_stack([b.column(len(keys) + i).cast(pa.float64()).to_numpy(zero_copy_only=False).astype("float64") for i in range(n_feature)])
                phi = leaf_values(tree, x)
                each = n_class * n_feature
                take = pa.array(np.repeat(np.arange(b.num_rows), each))
                classes = pa.array([c for c in tree.classes for _ in tree.features] * b.num_rows, pa.string() if text else pa.int64())
                phi = phi if digits is None else np.round(phi, digits)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i).take(take) for i in range(len(keys))], classes, pa.array(tree.features * (n_class * b.num_rows), pa.string()),
                     pa.array(phi.reshape(-1) + 0.0)], [*keys, "class", "feature", "phi"])

    return inputs.mapInArrow(run, schema)


def shap_report(values: DataFrame, eps: float = 1e-12, digits: int | None = 10) -> DataFrame:
    """Mean value per (class, feature), direction, and rank by ascending
    magnitude within the class (ties by feature name). One grouped aggregate;
    the ranking window sees classes x features rows."""
    m = values.groupBy("class", "feature").agg(F.avg("phi").alias("mean_shap"))
    if digits is not None:
        m = m.withColumn("mean_shap", F.round("mean_shap", digits))
    direction = (F.when(F.col("mean_shap") > eps, "toward")
                 .when(F.col("mean_shap") < -eps, "away").otherwise("neutral"))
    w = Window.partitionBy("class").orderBy(F.abs("mean_shap"), "feature")
    return (m.withColumn("direction", direction)
            .withColumn("rank", F.row_number().over(w).cast("int")))
