"""Classification metrics (A11-A16, X2, M11) against a brute-force definition."""

import random

import pytest

from petalframe.operators import metrics as M


def _brute(truth, pred, average):
    labels = sorted(set(truth) | set(pred))
    per = {}
    for l in labels:
        tp = sum(1 for t, p in zip(truth, pred) if t == p == l)
        np_ = sum(1 for p in pred if p == l)
        nt = sum(1 for t in truth if t == l)
        pr = tp / np_ if np_ else 0.0
        rc = tp / nt if nt else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        per[l] = (pr, rc, f1, nt)
    acc = sum(1 for t, p in zip(truth, pred) if t == p) / len(truth)
    if average == "macro":
        k = len(labels)
        return acc, sum(v[0] for v in per.values()) / k, sum(v[1] for v in per.values()) / k, \
            sum(v[2] for v in per.values()) / k
    n = len(truth)
    return acc, sum(v[0] * v[3] for v in per.values()) / n, sum(v[1] * v[3] for v in per.values()) / n, \
        sum(v[2] * v[3] for v in per.values()) / n


@pytest.mark.parametrize("average", ["macro", "weighted"])
def test_against_brute_force(spark, average):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randint(0, 2), rnd.randint(0, 3)) for _ in range(300)]
    rows.append(("c", 1, 1))  # single-row group
    df = spark.createDataFrame(rows, "g string, truth int, pred int")
    names = {"accuracy": "accuracy", "precision": f"precision_{average}", "recall": f"recall_{average}",
             "f1": f"f1_{average}"}
    got = {r["g"]: r for r in M.classification_metrics(df, "truth", "pred", "g", names, digits=None).collect()}
    for g in "abc":
        t = [r[1] for r in rows if r[0] == g]
        p = [r[2] for r in rows if r[0] == g]
        want = _brute(t, p, average)
        assert (got[g]["accuracy"], got[g]["precision"], got[g]["recall"], got[g]["f1"]) == pytest.approx(want)
        if average == "weighted":
            assert got[g]["recall"] == pytest.approx(got[g]["accuracy"])


def test_never_predicted_and_only_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (1, 2)], "truth int, pred int")
    r = M.classification_metrics(df, "truth", "pred", digits=None).first()
    # labels 0, 1, 2: precision (2/3 + 0 + 0) / 3
    assert r["precision"] == pytest.approx((2 / 3) / 3)
    assert r["recall"] == pytest.approx((1 + 0 + 0) / 3)


def test_difference_custom_and_gate(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 0, 1), ("y", 1, 1), ("y", 0, 0)], "g string, truth int, pred int")
    by = M.classification_metrics(df, "truth", "pred", "g")
    diff = {r["metric"]: r["difference"] for r in M.group_difference(by, ["accuracy"]).collect()}
    assert diff["accuracy"] == pytest.approx(0.5)
    err = {r["g"]: r["err"] for r in M.custom_metric(
        df, "truth", "pred", "g", lambda c: (c.n * (c.truth != c.pred)).sum() / c.n.sum(), "err").collect()}
    assert err == {"x": 0.5, "y": 0.0}
    gates = {r["gate"]: r["passed"] for r in M.quality_gate(
        M.classification_metrics(df, "truth", "pred"),
        [("acc", "accuracy", ">=", 0.75), ("prec", "precision", ">", 0.9)]).collect()}
    assert gates == {"acc": True, "prec": False}


def test_unscored_rows_are_wrong(spark):
    import duckdb

    from petalframe.plans.q_metrics import _MACRO, _WEIGHTED, _WEIGHTED_METRICS, metrics_sql

    df = spark.createDataFrame([(1, 1), (0, 0), (1, None)], "truth int, pred int")
    assert M.classification_metrics(df, "truth", "pred", metrics={"a": "accuracy", "n": "count"}).first() == (pytest.approx(2 / 3), 3)
    rows = [("x", 1, 1), ("x", 0, None), ("x", None, 1), ("x", None, None), ("x", 0, 0), ("x", 0, 1), ("y", 1, None), (None, 1, 1), (None, 1, None)]
    df = spark.createDataFrame(rows, "g string, truth int, pred int")
    values = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)
    cte = f"s AS (SELECT * FROM (VALUES {values}) v(g, truth, pred))"
    for select, metrics in ((_MACRO, None), (_WEIGHTED, _WEIGHTED_METRICS)):
        for group in ([], ["g"]):
            got = [tuple(r) for r in M.classification_metrics(df, "truth", "pred", group, metrics).collect()]
            want = duckdb.sql(metrics_sql(select, group, cte)).fetchall()
            assert sorted(got, key=repr) == sorted(want, key=repr)
    err = M.custom_metric(df, "truth", "pred", None, lambda c: (c.n * (c.truth != c.pred)).sum() / c.n.sum(), "err").first()["err"]
    assert err == pytest.approx(6 / 9)
