"""Running totals in two levels: equal to one window over everything, whatever the ranges."""

import random
from collections import defaultdict

import pytest

from petalframe.operators import checks, drift, prefix, sampling


def _rows():
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot"] * 5 + ["a", "b", None, ""]), rnd.randrange(10_000), i, rnd.choice([None, 1, 2, 5]), rnd.random()) for i in range(700)]
    return rows + [("one", 1, 1000, 7, 0.5)]


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_prefix_sums_per_group(spark, monkeypatch, ranges):
    monkeypatch.setattr(prefix, "BLOCK", 4)
    df = spark.createDataFrame(_rows(), "g string, x int, id int, n long, w double").repartition(5)
    out = prefix.prefix_sums(df, ["x", "id"], {"n_run": "n", "w_run": "w"}, by=["g"], ranges=ranges)
    assert out.columns == [*df.columns, "n_run", "w_run", "all_n_run", "all_w_run"]
    run, want = defaultdict(lambda: [0, 0.0]), {}
    for g, x, i, n, w in sorted(_rows(), key=lambda r: (r[1], r[2])):
        run[g] = [run[g][0] + (n or 0), run[g][1] + w]
        want[i] = (g, *run[g])
    got = out.collect()
    assert len(got) == len(want)
    for r in got:
        g, n, w = want[r.id]
        assert r.n_run == n and r.w_run == pytest.approx(w) and r.all_n_run == run[g][0] and r.all_w_run == pytest.approx(run[g][1])


@pytest.mark.parametrize("ranges", [1, 50])
def test_positions(spark, monkeypatch, ranges):
    monkeypatch.setattr(prefix, "BLOCK", 3)
    df = spark.createDataFrame(_rows(), "g string, x int, id int, n long, w double").repartition(6)
    got = prefix.positions(df, ["x", "id"], "at", ranges, total="of").collect()
    order = [r[2] for r in sorted(_rows(), key=lambda r: (r[1], r[2]))]
    assert {r["at"]: r.id for r in got} == dict(enumerate(order)) and {r["of"] for r in got} == {701}
    assert prefix.positions(df.limit(0), ["x"], "at").count() == 0


def test_no_single_partition_window_over_data(spark):
    """What each of these reads in one task is a row per range, never a row of the data."""
    df = spark.createDataFrame([(i, f"c{i % 9}", float(i % 31)) for i in range(300)], "id int, c string, v double")
    plans = [checks.distinct_classes(df, "c"), sampling.surrogate_key(df, ["id"]), drift.ks_statistic(drift.long_samples(df, df, ["v"])),
             sampling.split_quotas(df.groupBy("c").count().withColumnRenamed("count", "_n"), ["c"], 0.2)]
    for p in plans:
        text = p._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in text, text


def test_many_strata_and_classes(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(3_000)], "id int, c int")
    s = sampling.stratified_split(df, "id", "c", 0.2, 42)
    assert s.where("split = 'test'").count() == 600
    assert s.where("split = 'test'").groupBy("c").count().agg({"count": "max"}).first()[0] == 1
    got = checks.distinct_classes(df, "c").collect()
    assert sorted((r.c, r.class_index, r.n_classes) for r in got) == [(c, c, 1_000) for c in range(1_000)]
