"""KS statistic / p-value and histograms."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from petalframe.operators import drift


def _frames(spark, a, b):
    return (spark.createDataFrame([(float(x),) for x in a], "v double"),
            spark.createDataFrame([(float(x),) for x in b], "v double"))


def _ks_brute(a, b):
    pts = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in pts)


def _p_exact(n, d):
    h = round(d * n)
    if h == 0:
        return 1.0
    c = math.comb(2 * n, n)
    s = sum(Fraction((-1) ** (j - 1) * math.comb(2 * n, n - j * h), c) for j in range(1, n // h + 1))
    return float(2 * s)


@pytest.mark.parametrize("a,b", [
    ([1, 2, 3], [1, 2, 3]),
    ([1, 2, 3], [10, 11, 12, 13, 14]),
    ([1, 1, 1, 2, 2, 3], [1, 2, 2, 2, 3, 3, 3]),
    ([0.5, 1.5, 2.5], [1.0, 2.0, 3.0, 4.0, 0.0]),
])
def test_ks_statistic_brute_force(spark, a, b):
    fa, fb = _frames(spark, a, b)
    r = drift.drift_report(fa, fb, ["v"], digits=None).first()
    assert r["ks_statistic"] == pytest.approx(_ks_brute(a, b))
    r2 = drift.drift_report(fb, fa, ["v"], digits=None).first()
    assert r2["ks_statistic"] == pytest.approx(r["ks_statistic"])  # symmetric


def test_ks_identical_and_ranges(spark):
    rnd = random.Random(1)
    a = [rnd.gauss(0, 1) for _ in range(500)]
    b = [x + 0.3 for x in a[:400]] + a[400:]
    fa, fb = _frames(spark, a, b)
    long = drift.long_samples(fa, fb, ["v"])
    # few ranges and many ranges must give the same statistic
    d1 = drift.ks_statistic(long, n_ranges=2).first()["ks_statistic"]
    d2 = drift.ks_statistic(long, n_ranges=300).first()["ks_statistic"]
    assert d1 == pytest.approx(d2) == pytest.approx(_ks_brute(a, b))
    same = drift.drift_report(fa, fa, ["v"]).first()
    assert same["ks_statistic"] == 0 and same["p_value"] == 1.0 and not same["drift_detected"]


def test_exact_pvalue_published_case(spark):
    # 150 vs 150 rows, D = 1/3 (a shift of one feature by +1.0): p = 8.870018441363217e-08
    p, m = drift.ks_pvalue(F.lit(150), F.lit(150), F.lit(1 / 3))
    r = spark.range(1).select(p.alias("p"), m.alias("m")).first()
    assert r["m"] == "exact"
    assert r["p"] == pytest.approx(8.870018441363217e-08, rel=1e-9)
    assert r["p"] == pytest.approx(_p_exact(150, 1 / 3), rel=1e-9)


@pytest.mark.parametrize("n,d", [(5, 0.6), (40, 0.25), (300, 0.1), (1000, 0.05)])
def test_exact_pvalue_formula(spark, n, d):
    p, _ = drift.ks_pvalue(F.lit(n), F.lit(n), F.lit(d))
    assert spark.range(1).select(p).first()[0] == pytest.approx(_p_exact(n, d), rel=1e-9, abs=1e-15)


def test_asymptotic_beyond_ten_thousand(spark):
    p, m = drift.ks_pvalue(F.lit(300), F.lit(10_001), F.lit(0.1))
    r = spark.range(1).select(p.alias("p"), m.alias("m")).first()
    lam = 0.1 * math.sqrt(300 * 10_001 / 10_301)
    want = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert r["m"] == "asymptotic" and r["p"] == pytest.approx(want)


def _p_paths(n, m, h):
    """Exact: paths that stay where |i * m - j * n| < h, in whole numbers."""
    rows = [0] * (m + 1)
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) >= h:
                rows[j] = 0
            elif i == j == 0:
                rows[j] = 1
            else:
                rows[j] = (rows[j] if i else 0) + (rows[j - 1] if j else 0)
    return float(1 - Fraction(rows[m], math.comb(n + m, n)))


@pytest.mark.parametrize("n,m", [(1, 1), (1, 7), (10, 12), (12, 10), (9, 6), (40, 25), (150, 151), (200, 300)])
def test_exact_pvalue_by_path_counts(n, m):
    lcm = n * m // math.gcd(n, m)
    for k in sorted({1, 2, 3, lcm // 20, lcm // 7, lcm // 4, lcm // 3, lcm // 2, lcm - 1, lcm} - {0}):
        assert drift.paths_outside(n, m, k / lcm) == pytest.approx(_p_paths(n, m, k * math.gcd(n, m)), rel=1e-9, abs=1e-14)
    assert drift.paths_outside(n, m, 0.0) == 1.0


def test_exact_pvalue_equal_sizes_agree_up_to_ten_thousand():
    # the closed form for equal sizes, another way to the same number
    for n, d in ((150, 1 / 3), (5_000, 0.03), (10_000, 0.02), (10_000, 0.06)):
        h = round(d * n)
        want = 2 * sum((-1) ** (j - 1) * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - j * h + 1) - math.lgamma(n + j * h + 1))
                       for j in range(1, n // h + 1))
        assert drift.paths_outside(n, n, h / n) == pytest.approx(want, rel=1e-6)
    assert drift.paths_outside(10_000, 9_999, 0.5) < 1e-300 < drift.paths_outside(9_999, 10_000, 0.1)


def test_report_of_unequal_sizes_is_exact(spark):
    rnd = random.Random(4)
    a, b = [rnd.gauss(0, 1) for _ in range(10)], [rnd.gauss(1, 1) for _ in range(12)]
    r = drift.drift_report(*_frames(spark, a, b), ["v"], digits=None).first()
    assert r["p_method"] == "exact" and r["p_value"] == pytest.approx(_p_paths(10, 12, round(_ks_brute(a, b) * 120)), rel=1e-9)


def test_nan_rejected_and_histogram(spark):
    fa = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,), (5.0,)], "v double")
    fb = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    long = drift.long_samples(fa, fb, ["v"])
    assert long.count() == 5
    h = {(r["sample"], r["bin"]): r["count"] for r in drift.histogram(long).collect()}
    assert len(h) == 30
    assert h[(0, 0)] == 1 and h[(0, 14)] == 1 and h[(0, 7)] == 1  # max lands in the last bin
    assert h[(1, 7)] == 2  # constant column: range widened by 0.5 each way
    assert sum(v for (s, _), v in h.items() if s == 0) == 3


def test_shift(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    r = drift.shift(df, "a", 1.0).first()
    assert (r["a"], r["b"]) == (2.0, 2.0)
