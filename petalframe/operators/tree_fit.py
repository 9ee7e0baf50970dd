"""Decision trees with exact thresholds (M3).

Level by level: the rows of every open node are counted per (node, feature,
value, class) - a partial aggregate - and prefix sums of the class counts, in
the order of the values, give the class counts left of every possible cut. The
best cut of each node is one aggregate; only one row per node reaches the
driver. Prefix sums run in two levels over range partitions, so a feature with
any number of distinct values, or a node that holds all rows, spans many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.operators.metrics import classification_metrics
from petalframe.operators.models import class_index, class_labels, fit_parallel
from petalframe.operators.prefix import prefix_sums
from petalframe.operators.treeshap import Node, Tree, predict
from petalframe.session import materialize

#: Digits to which two cuts are told apart; nearer ones are a tie.
DIGITS = 9


def _purity(counts: list, total: Column, impurity: str) -> Column:
    """What one side of a cut adds to the score: larger is purer."""
    if impurity == "gini":
        return sum((c * c for c in counts[1:]), counts[0] * counts[0]) / total
    if impurity == "entropy":
        terms = [F.when(c > 0, c * F.log(c / total)).otherwise(F.lit(0.0)) for c in counts]
        return sum(terms[1:], terms[0])
    raise ValueError(f"impurity {impurity!r}: 'gini' or 'entropy'")


def _node_of(nodes: dict, cols: dict, at: int = 1) -> Column:
    n = nodes[at]
    if n.left is None:
        return F.lit(at)
    # a missing value is NaN, larger than any threshold
    return F.when(cols[n.feature] <= F.lit(n.threshold), _node_of(nodes, cols, n.left)).otherwise(_node_of(nodes, cols, n.right))


def fit_exact_tree(train: DataFrame, features: list, label: str, max_depth: int = 4, impurity: str = "gini",
                   min_rows: int = 1, ranges: int | None = None) -> Tree:
    """A greedy tree whose thresholds are the midpoints between neighbouring
    values. Ties go to the earlier feature, then the smaller value. Nodes are
    numbered from 1, children of i are 2i and 2i + 1; a node is split while it
    is impure, above ``max_depth`` and has a cut that leaves ``min_rows`` on
    either side. Rows without a label play no part; a missing value (NULL, NaN)
    goes right."""
    labels = class_labels(train, label)
    cols = {f: f"_x{i}" for i, f in enumerate(features)}
    nan = F.lit(float("nan"))
    rows = materialize(train.where(F.col(label).isNotNull()).select(
        class_index(label, labels).cast("int").alias("_y"), *[F.coalesce(F.col(f).cast("double"), nan).alias(c) for f, c in cols.items()]), "tree")
    classes = [f"c{k}" for k in range(len(labels))]
    root = rows.agg(*[F.count_if(F.col("_y") == k).alias(c) for k, c in enumerate(classes)]).first()
    nodes = {1: Node(1, [root[c] for c in classes])}
    open_nodes = [1]
    for depth in range(max_depth):
        open_nodes = [i for i in open_nodes if sum(c > 0 for c in nodes[i].counts) > 1]
        if not open_nodes:
            break
        at = rows.withColumn("_n", _node_of(nodes, {f: F.col(c) for f, c in cols.items()})).where(F.col("_n").isin(open_nodes))
        long = at.select("_n", "_y", F.posexplode(F.array(*cols.values())).alias("_f", "_x"))
        counts = materialize(long.groupBy("_n", "_f", "_x").agg(*[F.count_if(F.col("_y") == k).alias(c) for k, c in enumerate(classes)]), "tree-counts")
        run = prefix_sums(counts, ["_x"], {f"l{c}": c for c in classes}, by=["_n", "_f"], ranges=ranges)
        left, whole = [F.col(f"l{c}") for c in classes], [F.col(f"all_l{c}") for c in classes]
        n_left, n_all = sum(left[1:], left[0]), sum(whole[1:], whole[0])
        right = [w - x for w, x in zip(whole, left)]
        score = F.round((_purity(left, n_left, impurity) + _purity(right, n_all - n_left, impurity)) / n_all, DIGITS)
        cuts = run.where(~F.isnan("_x") & (n_left >= min_rows) & (n_all - n_left >= max(1, min_rows))).select(
            "_n", "_f", "_x", score.alias("score"), *[x.alias(c) for x, c in zip(left, classes)])
        best = materialize(cuts.groupBy("_n").agg(F.max_by(F.struct("_f", "_x", *classes), F.struct("score", -F.col("_f"), -F.col("_x"))).alias("b")), "cuts")
        above = (counts.join(F.broadcast(best.select("_n", F.col("b._f").alias("_f"), F.col("b._x").alias("_cut"))), ["_n", "_f"])
                 .where(F.col("_x") > F.col("_cut")).groupBy("_n").agg(F.min("_x").alias("next")))
        found = best.join(above, "_n").collect()  # one row per open node
        open_nodes = []
        for r in found:
            n, b = nodes[r["_n"]], r["b"]
            # only missing values lie above the cut: any threshold from it on parts them
            n.threshold = b["_x"] if r["next"] != r["next"] else (b["_x"] + r["next"]) / 2
            n.feature, n.left, n.right = features[b["_f"]], 2 * n.id, 2 * n.id + 1
            mine = [b[c] for c in classes]
            nodes[n.left], nodes[n.right] = Node(n.left, mine), Node(n.right, [w - x for w, x in zip(n.counts, mine)])
            open_nodes += [n.left, n.right]
    return Tree(list(nodes.values()), labels, features)


def exact_grid(train: DataFrame, test: DataFrame, features: list, label: str, depths=(2, 3), criteria=("gini", "entropy")) -> DataFrame:
    """M4 with exact thresholds: ``run_id, max_depth, criterion`` and the macro
    metrics on ``test``, whose rows are read once and scored by all trees."""
    grid = [(i + 1, d, c) for i, (d, c) in enumerate((d, c) for d in depths for c in criteria)]
    trees = fit_parallel([lambda d=d, c=c: fit_exact_tree(train, features, label, d, c) for _, d, c in grid])
    scored = test.select(label, *features)
    for (run, _, _), tree in zip(grid, trees):
        scored = predict(scored, tree, f"_leaf_{run}", f"_p_{run}")
    runs = [F.struct(F.lit(r).alias("run_id"), F.lit(d).alias("max_depth"), F.lit(c).alias("criterion"), F.col(f"_p_{r}").alias("prediction"))
            for r, d, c in grid]
    scored = scored.select(label, F.explode(F.array(*runs)).alias("_s")).select(label, "_s.*")
    return classification_metrics(scored, label, "prediction", ["run_id", "max_depth", "criterion"])
