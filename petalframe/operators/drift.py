"""Two-sample drift statistics and histograms: A17-A20, P6, P10, J9.

Both samples go into one long frame ``(feature, x, sample)`` (an unpivot of
the wide tables tagged by sample), so all features are handled by one job.

KS statistic (A18): the supremum of |F_a - F_b| over pooled values with
right-continuous ECDFs. Ties are collapsed first by a grouped count per
(feature, value); the running sums that follow are taken in two levels over
range partitions (:mod:`petalframe.operators.prefix`), so no task sees more
than a range of one feature's values.

KS p-value (A19): exact up to 10,000 rows a sample. Of all orders in which the
rows of both samples can be drawn one by one, the p-value is the share in which
the ECDFs get at least that far apart: lattice paths that touch the outside of
a band. That share is carried along the anti-diagonals, a vector at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.operators.prefix import prefix_sums
from petalframe.session import bounded_broadcast, materialize

EXACT_MAX_N = 10000
LEVEL = 0.05


def shift(df: DataFrame, col: str, offset: float) -> DataFrame:
    """Simulated drift - add ``offset`` to one column, others unchanged."""
    return df.withColumn(col, F.col(col) + F.lit(offset))


def long_samples(a: DataFrame, b: DataFrame, features: list) -> DataFrame:
    """``(feature, x, sample)`` with sample 0 = reference, 1 = current."""
    def one(df, tag):
        w = df.select(*[F.col(c).cast("double").alias(c) for c in features])
        return w.unpivot([], features, "feature", "x").withColumn("sample", F.lit(tag))

    out = one(a, 0).unionByName(one(b, 1))
    return out.where(F.col("x").isNotNull() & ~F.isnan("x"))


def ks_statistic(long: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """``(feature, n_a, n_b, ks_statistic)``. ``n_ranges``: ranges the
    distinct values of all features are cut into (the shuffle partitions, by
    default); it only changes speed."""
    cnt = materialize(long.groupBy("feature", "x").agg(F.sum(1 - F.col("sample")).cast("long").alias("ca"),
                                                       F.sum("sample").cast("long").alias("cb")), "ks-counts")
    run = prefix_sums(cnt, ["x"], {"ra": "ca", "rb": "cb"}, by=["feature"], ranges=n_ranges)
    apart = F.abs(F.col("ra") / F.col("all_ra") - F.col("rb") / F.col("all_rb"))
    return run.groupBy("feature").agg(F.first("all_ra").alias("n_a"), F.first("all_rb").alias("n_b"), F.max(apart).alias("ks_statistic"))


def paths_outside(n: int, m: int, d: float) -> float:
    """Share of the lattice paths from (0, 0) to (n, m) on which ``|i / n - j / m|``
    reaches ``d``: the exact two-sided KS p-value for samples of n and m rows.

    ``q[i]`` is that share for paths to the point (i, s - i) of anti-diagonal s:
    1 outside the band, else a mean of its two predecessors, weighted by the
    paths through them. All terms are positive, so small values keep their
    relative precision. The band of a diagonal is one slice of ``q``.
    """
    g = math.gcd(n, m)
    h = round(d * (n // g) * m) * g  # outside: |i * m - j * n| >= h
    if h <= 0:
        return 1.0
    q = np.ones(n + 2)  # q[i + 1]; q[0] stands for i = -1 and has weight 0
    q[1] = 0.0
    i = np.arange(n + 1, dtype=np.float64)
    low = 0
    for s in range(1, n + m + 1):
        lo = max(0, s - m, (s * n - h) // (n + m) + 1)
        hi = min(n, s, -((-s * n - h) // (n + m)) - 1)
        if lo > hi:
            return 1.0
        new = (i[lo:hi + 1] * q[lo:hi + 1] + (s - i[lo:hi + 1]) * q[lo + 1:hi + 2]) / s
        q[low + 1:lo + 1] = 1.0  # cells the band has left
        q[lo + 1:hi + 2] = new
        low = lo
    return float(min(1.0, max(0.0, q[n + 1])))


@F.pandas_udf(T.DoubleType())
def _paths_outside(n: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else paths_outside(int(a), int(b), float(x)) for a, b, x in zip(n, m, d)], dtype="float64")


def ks_pvalue(n_a: Column, n_b: Column, d: Column) -> tuple[Column, Column]:
    """Two-sided p-value and the method used.

    Equal sizes n <= 10 000: exact, ``p = 2 sum_j (-1)^(j-1) C(2n, n-jh)/C(2n, n)``
    with ``h = round(D n)``, evaluated from the innermost term outwards
    (Horner form) so the whole sum costs O(n) multiplications. Unequal sizes
    up to 10 000: exact, :func:`paths_outside` (one call per feature). Otherwise the
    Kolmogorov series with ``lambda = D sqrt(n m / (n + m))``, 100 terms,
    clamped to [0, 1].
    """
    n = n_a.cast("long")
    h = F.round(d * n).cast("long")
    hh = F.greatest(h, F.lit(1).cast("long"))
    one = F.lit(1).cast("long")

    def step(acc, k):
        # C(2n, n-(k+1)h) / C(2n, n-kh) as a product of h factors
        ratio = F.aggregate(F.sequence(F.lit(0).cast("long"), hh - one), F.lit(1.0),
                            lambda p, j: p * (n - k * hh - j) / (n + k * hh + j + 1))
        return ratio * (1 - acc)

    horner = F.aggregate(F.sequence(F.floor(n / hh).cast("long"), F.lit(0).cast("long"), -one),
                         F.lit(0.0), step)
    exact = F.when(h == 0, F.lit(1.0)).otherwise(F.least(F.greatest(2 * horner, F.lit(0.0)), F.lit(1.0)))
    lam = d * F.sqrt(n_a * n_b / (n_a + n_b))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(-2.0 * k * k * lam * lam))
    asym = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))
    small = (n_a <= EXACT_MAX_N) & (n_b <= EXACT_MAX_N)
    unequal = small & (n_a != n_b) & (n_a > 0) & (n_b > 0)
    counted = _paths_outside(F.when(unequal, n_a.cast("long")), F.when(unequal, n_b.cast("long")), d)
    p = F.when(small & (n_a == n_b), exact).when(unequal, counted).otherwise(asym)
    return p, F.when(small, F.lit("exact")).otherwise(F.lit("asymptotic"))


def drift_report(a: DataFrame, b: DataFrame, features: list, level: float = LEVEL,
                 digits: int | None = 10) -> DataFrame:
    """``(feature, ks_statistic, p_value, drift_detected, p_method, n_a, n_b)``."""
    ks = ks_statistic(long_samples(a, b, features))
    p, method = ks_pvalue(F.col("n_a"), F.col("n_b"), F.col("ks_statistic"))
    out = ks.withColumn("p_value", p).withColumn("p_method", method)
    out = out.withColumn("drift_detected", F.col("p_value") < F.lit(level))  # P10
    if digits is not None:
        out = out.withColumn("ks_statistic", F.round("ks_statistic", digits)).withColumn(
            "p_value", F.round("p_value", digits))
    return out.select("feature", "ks_statistic", "p_value", "drift_detected", "p_method",
                      F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"))


def histogram(long: DataFrame, bins: int = 15, digits: int | None = 10) -> DataFrame:
    """Fixed-width histogram per (feature, sample) over its own min..max.

    ``bin = least(floor((x - min) / (max - min) * bins), bins - 1)``: the last
    bin is closed. A constant column widens its range by 0.5 each way. Empty
    bins are present with count 0. Ranges are a per-(feature, sample)
    aggregate, broadcast back.
    """
    rng = (long.groupBy("feature", "sample").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
           .withColumn("lo", F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")))
           .withColumn("hi", F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")))
           .drop("mn", "mx"))
    # one row per (feature, sample): written once, then broadcast after its size check
    rng, _ = bounded_broadcast(rng)
    binned = (long.join(rng, ["feature", "sample"])
              .withColumn("bin", F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                                         F.lit(bins - 1)).cast("int")))
    counts = binned.groupBy("feature", "sample", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    out = (grid.join(counts, ["feature", "sample", "bin"], "left")
           .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
           .withColumn("bin_lo", F.col("lo") + F.col("bin") * width)
           .withColumn("bin_hi", F.col("lo") + (F.col("bin") + 1) * width))
    if digits is not None:
        out = out.withColumn("bin_lo", F.round("bin_lo", digits)).withColumn("bin_hi", F.round("bin_hi", digits))
    return out.select("feature", "sample", "bin", "bin_lo", "bin_hi", "count")
