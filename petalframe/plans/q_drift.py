"""Drift queries: KS statistic and p-value per feature, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.operators import drift
from petalframe.plans.registry import register
from petalframe.sources.io import Tables

MIDPOINT = "2024-01-16 00:00:00"
SHIFT = 1.0


def _events(t):
    return t.events.select("ts", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


def _halves(t):
    e = _events(t)
    cut = F.lit(MIDPOINT).cast("timestamp_ntz")
    return e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)


_LONG_HALVES = f"""
e AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
long AS (SELECT 'value' AS feature, value AS x, CASE WHEN ts < TIMESTAMP '{MIDPOINT}' THEN 0 ELSE 1 END AS sample FROM e
         UNION ALL SELECT 'k', CAST(k AS DOUBLE), CASE WHEN ts < TIMESTAMP '{MIDPOINT}' THEN 0 ELSE 1 END FROM e)"""

_LONG_SHIFT = f"""
e AS (SELECT value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
long AS (SELECT 'value' AS feature, value AS x, 0 AS sample FROM e
         UNION ALL SELECT 'k', CAST(k AS DOUBLE), 0 FROM e
         UNION ALL SELECT 'value', value + {SHIFT}, 1 FROM e
         UNION ALL SELECT 'k', CAST(k AS DOUBLE), 1 FROM e)"""

_KS = """
long2 AS (SELECT * FROM long WHERE x IS NOT NULL AND NOT isnan(x)),
cnt AS (SELECT feature, x, sum(1 - sample) AS ca, sum(sample) AS cb FROM long2 GROUP BY ALL),
cum AS (SELECT feature,
          sum(ca) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) / sum(ca) OVER (PARTITION BY feature) AS fa,
          sum(cb) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) / sum(cb) OVER (PARTITION BY feature) AS fb,
          sum(ca) OVER (PARTITION BY feature) AS n_a, sum(cb) OVER (PARTITION BY feature) AS n_b
        FROM cnt),
ks AS (SELECT feature, max(abs(fa - fb)) AS d, CAST(any_value(n_a) AS BIGINT) AS n_a,
              CAST(any_value(n_b) AS BIGINT) AS n_b FROM cum GROUP BY feature)"""

_P = """
pv AS (SELECT *, CAST(round(d * n_a) AS BIGINT) AS h, d * sqrt(n_a * n_b / (n_a + n_b)) AS lam,
              n_a <= 10000 AND n_b <= 10000 AS use_exact FROM ks),
-- paths to (i, s - i) that have left the band |i * n_b - j * n_a| < hh, diagonal by diagonal; cells lo .. hi lie inside
start AS (SELECT feature, n_a AS n, n_b AS m, CAST(round(d * n_a * n_b / gcd(n_a, n_b)) AS BIGINT) * gcd(n_a, n_b) AS hh
          FROM pv WHERE use_exact AND n_a <> n_b AND n_a > 0 AND n_b > 0),
walk AS (
  SELECT feature, n, m, hh, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS hi, [CAST(0 AS DOUBLE)] AS q FROM start WHERE hh > 0
  UNION ALL
  SELECT feature, n, m, hh, s, lo, hi,
    list_transform(range(lo, hi + 1), lambda i: (i * CASE WHEN i - 1 BETWEEN plo AND phi THEN pq[i - plo] ELSE 1.0 END
      + (s - i) * CASE WHEN i BETWEEN plo AND phi THEN pq[i - plo + 1] ELSE 1.0 END) / s) AS q
  FROM (SELECT feature, n, m, hh, s + 1 AS s, lo AS plo, hi AS phi, q AS pq,
          greatest(0, s + 1 - m, CAST(floor(((s + 1) * n - hh) / (n + m)) AS BIGINT) + 1) AS lo,
          least(n, s + 1, CAST(ceil(((s + 1) * n + hh) / (n + m)) AS BIGINT) - 1) AS hi
        FROM walk WHERE s < n + m)),
counted AS (SELECT feature, coalesce(q[n - lo + 1], 1.0) AS p FROM walk WHERE s = n + m),
pe AS (SELECT feature,
         CASE WHEN h = 0 THEN 1.0 WHEN n_a <> n_b THEN (SELECT p FROM counted c WHERE c.feature = pv.feature)
           ELSE least(greatest(2 * (
           SELECT sum(CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END
                      * exp(2 * lgamma(n_a + 1) - lgamma(n_a - j * h + 1) - lgamma(n_a + j * h + 1)))
           FROM range(1, n_a // greatest(h, 1) + 1) t(j)), 0.0), 1.0) END AS p_exact,
         CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * (
           SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam))
           FROM range(1, 101) t(k)), 0.0), 1.0) END AS p_asym
       FROM pv)
SELECT pv.feature, round(pv.d, 10) AS ks_statistic,
       round(CASE WHEN use_exact THEN p_exact ELSE p_asym END, 10) AS p_value,
       CASE WHEN use_exact THEN p_exact ELSE p_asym END < 0.05 AS drift_detected,
       CASE WHEN use_exact THEN 'exact' ELSE 'asymptotic' END AS p_method,
       pv.n_a, pv.n_b
FROM pv JOIN pe USING (feature)"""


@register("drift_ks", "WITH RECURSIVE " + _LONG_HALVES + "," + _KS + "," + _P)
def drift_ks(spark, sf_dir):
    """Events of the first vs the second half of the month (sizes differ)."""
    a, b = _halves(Tables(spark, sf_dir))
    return drift.drift_report(a, b, ["value", "k"])


@register("drift_report", "WITH RECURSIVE " + _LONG_SHIFT + "," + _KS + "," + _P)
def drift_report(spark, sf_dir):
    """Events vs a copy with value + 1.0 (equal sizes: exact p-value up to 10 000 rows)."""
    e = _events(Tables(spark, sf_dir))
    return drift.drift_report(e, drift.shift(e, "value", SHIFT), ["value", "k"])


_LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("drift_lineitem", "WITH RECURSIVE long AS (" + "\n UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS x, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS sample "
    f"FROM lineitem" for c in _LINE_FEATURES) + ")," + _KS + "," + _P)
def drift_lineitem(spark, sf_dir):
    """A18-A20 at lineitem size: returned items ('R') vs all others ('N', 'A')."""
    li = Tables(spark, sf_dir).lineitem
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    return drift.drift_report(li.where(~returned), li.where(returned), _LINE_FEATURES)


@register("drift_histogram", "WITH " + _LONG_HALVES + """,
long2 AS (SELECT * FROM long WHERE x IS NOT NULL AND NOT isnan(x)),
rng0 AS (SELECT feature, sample, min(x) AS mn, max(x) AS mx FROM long2 GROUP BY ALL),
rng AS (SELECT feature, sample, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
               CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rng0),
b AS (SELECT l.feature, l.sample, CAST(least(floor((l.x - r.lo) / (r.hi - r.lo) * 15), 14) AS INTEGER) AS bin
      FROM long2 l JOIN rng r USING (feature, sample)),
c AS (SELECT feature, sample, bin, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT r.*, CAST(s.bin AS INTEGER) AS bin FROM rng r CROSS JOIN range(0, 15) s(bin))
SELECT g.feature, g.sample, g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 15), 10) AS bin_lo,
       round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / 15), 10) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM g LEFT JOIN c USING (feature, sample, bin)
""")
def drift_histogram(spark, sf_dir):
    """15-bin histograms per feature and half."""
    a, b = _halves(Tables(spark, sf_dir))
    return drift.histogram(drift.long_samples(a, b, ["value", "k"]))
