"""Tree scoring and Shapley values (M6, M9, M10) against brute force."""

import itertools
import math
import random

import pytest

from petalframe.operators import treeshap
from petalframe.plans.q_shap import FEATURES, fixed_tree


def _f_subset(tree, x, S, ci):
    """Expected output with features outside S following both branches by cover."""
    def walk(nid):
        n = tree.nodes[nid]
        if n.left is None:
            return n.counts[ci] / sum(n.counts)
        if n.feature in S:
            return walk(n.left if x[n.feature] <= n.threshold else n.right)
        tot = sum(n.counts)
        return (sum(tree.nodes[n.left].counts) / tot * walk(n.left)
                + sum(tree.nodes[n.right].counts) / tot * walk(n.right))
    return walk(tree.root)


def _shap_brute(tree, x, ci):
    M = len(FEATURES)
    out = {}
    for f in FEATURES:
        others = [g for g in FEATURES if g != f]
        v = 0.0
        for k in range(M):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                v += w * (_f_subset(tree, x, set(S) | {f}, ci) - _f_subset(tree, x, set(S), ci))
        out[f] = v
    return out


def _rows(n=40, seed=2):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(4, 8), rnd.uniform(2, 4.5), rnd.uniform(1, 7), rnd.uniform(0, 2.5)) for i in range(n)]


def test_shap_equals_brute_force_and_sums(spark):
    tree = fixed_tree()
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in FEATURES))
    vals = treeshap.shap_values(df, tree, ["id"], digits=None).collect()
    got = {(r["id"], r["class"], r["feature"]): r["phi"] for r in vals}
    base = tree.base_value
    for i, *xs in rows:
        x = dict(zip(FEATURES, xs))
        for ci, c in enumerate(tree.classes):
            want = _shap_brute(tree, x, ci)
            for f in FEATURES:
                assert got[(i, c, f)] == pytest.approx(want[f], abs=1e-12)
            # efficiency: values add up to prediction - base value
            total = sum(got[(i, c, f)] for f in FEATURES)
            assert total == pytest.approx(_f_subset(tree, x, set(FEATURES), ci) - base[ci], abs=1e-12)
        # over classes the values of a feature sum to 0
        for f in FEATURES:
            assert sum(got[(i, c, f)] for c in tree.classes) == pytest.approx(0, abs=1e-12)


def _random_tree(rnd, depth, features, names=("a", "b", "c")):
    nodes, ids = [], itertools.count(1)

    def grow(level, counts):
        i = next(ids)
        if level == 0 or sum(counts) < 2 or rnd.random() < 0.1:
            nodes.append(treeshap.Node(i, counts))
            return i
        left = [rnd.randint(0, c) for c in counts]
        if not 0 < sum(left) < sum(counts):
            nodes.append(treeshap.Node(i, counts))
            return i
        right = [c - x for c, x in zip(counts, left)]
        n = treeshap.Node(i, counts, feature=rnd.choice(features), threshold=rnd.uniform(0, 10))
        n.left, n.right = grow(level - 1, left), grow(level - 1, right)
        nodes.append(n)
        return i

    grow(depth, [400, 300, 500])
    return treeshap.Tree(nodes, list(names), features)


def test_deep_trees_and_missing_values(spark, monkeypatch):
    """Features met again and again on a path; NULL and NaN go right, as in scoring."""
    monkeypatch.setattr(treeshap, "SLICE_ROWS", 7)
    rnd = random.Random(3)
    for depth in (1, 4, 9):
        tree = _random_tree(rnd, depth, FEATURES)
        rows = [(i, *(rnd.choice([rnd.uniform(0, 10), rnd.uniform(0, 10), None, float("nan")]) for _ in FEATURES)) for i in range(30)]
        df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in FEATURES))
        got = {(r["id"], r["class"], r["feature"]): r["phi"] for r in treeshap.shap_values(df, tree, ["id"], digits=None).collect()}
        assert len(got) == 30 * 3 * len(FEATURES)
        scored = {r["id"]: (r["leaf"], r["prediction"]) for r in treeshap.predict(df, tree).collect()}
        for i, *xs in rows:
            x = {f: math.inf if v is None or math.isnan(v) else v for f, v in zip(FEATURES, xs)}
            for ci, c in enumerate(tree.classes):
                want = _shap_brute(tree, x, ci)
                assert all(got[i, c, f] == pytest.approx(want[f], abs=1e-11) for f in FEATURES)
                leaf = tree.nodes[scored[i][0]]
                assert sum(got[i, c, f] for f in FEATURES) == pytest.approx(leaf.counts[ci] / sum(leaf.counts) - tree.base_value[ci], abs=1e-11)


def test_a_path_of_forty_features():
    """2**40 subsets: only the sum is checked (value of the leaf minus the base value)."""
    import numpy as np

    names = [f"f{i}" for i in range(40)]
    nodes = []
    for i in range(40):
        n = 1000 - 20 * i
        nodes.append(treeshap.Node(2 * i + 1, [n // 2 + i, n - n // 2 - i], 2 * i + 2, 2 * i + 3, names[i], 0.5))
        nodes.append(treeshap.Node(2 * i + 2, [20 - i % 20, i % 20]))
    nodes.append(treeshap.Node(81, [150, 50]))
    tree = treeshap.Tree(nodes, ["n", "y"], names)
    x = np.random.default_rng(1).random((50, 40)) * 0.6 + 0.3
    phi = treeshap.leaf_values(tree, x)
    for r, row in enumerate(x):
        i = next((k for k in range(40) if row[k] <= 0.5), None)
        leaf = tree.nodes[81 if i is None else 2 * i + 2]
        for c in range(2):
            expected = sum(lf.value[c] * np.prod(list(lf.cover.values())) for lf in tree.leaves)
            assert phi[r, c].sum() == pytest.approx(leaf.counts[c] / sum(leaf.counts) - expected, abs=1e-10)


def test_predict_and_report(spark):
    tree = fixed_tree()
    df = spark.createDataFrame([(1, 5.0, 3.0, 1.4, 0.2), (2, 6.0, 3.0, 4.5, 1.5), (3, 6.5, 3.0, 6.0, 2.2)],
                               "id int, " + ", ".join(f"{f} double" for f in FEATURES))
    pred = {r["id"]: (r["leaf"], r["prediction"]) for r in treeshap.predict(df, tree).collect()}
    assert pred == {1: (1, "setosa"), 2: (5, "versicolor"), 3: (14, "virginica")}
    rep = treeshap.shap_report(treeshap.shap_values(df, tree, ["id"])).collect()
    assert len(rep) == 12
    sl = [r for r in rep if r["feature"] == "sepal_length"]
    assert all(r["direction"] == "neutral" and r["mean_shap"] == 0 for r in sl)
    for c in tree.classes:
        ranked = sorted((r["rank"], abs(r["mean_shap"]), r["feature"]) for r in rep if r["class"] == c)
        assert [x[0] for x in ranked] == [1, 2, 3, 4]
        assert [x[1:] for x in ranked] == sorted(x[1:] for x in ranked)  # ascending magnitude, ties by name


def test_tree_from_saved_model(spark, tmp_dir):
    from petalframe.operators import models

    rows = [(float(i % 7), float((i * 3) % 5), int(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    m = models.fit_tree(df, ["a", "b"], "label", max_depth=3)
    models.save_model(m, tmp_dir + "/tree")
    tree = treeshap.Tree.from_spark_model(spark, tmp_dir + "/tree", ["a", "b"], [0, 1])
    scored = m.transform(df)
    mine = treeshap.predict(df, tree, prediction="p2")
    a = [r["prediction"] for r in scored.orderBy("a", "b").collect()]
    b = [int(r["p2"]) for r in mine.orderBy("a", "b").collect()]
    assert a == b
