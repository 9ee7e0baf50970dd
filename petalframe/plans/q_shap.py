"""Tree scoring and Shapley-value queries with a fixed node table.

The tree is fixed so that results do not depend on which of two equally good
splits a learner picks; it is applied to four features derived from
``events``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.operators.treeshap import Node, Tree, predict, shap_report, shap_values
from petalframe.plans.registry import register
from petalframe.sources.io import Tables

# Node table of a depth-4 classification tree
# (id, class counts setosa/versicolor/virginica, left, right, feature, threshold; x <= threshold goes left).
FIXED_NODES = [
    (0, (50, 50, 50), 1, 2, "petal_length", 2.45),
    (1, (50, 0, 0), None, None, None, None),
    (2, (0, 50, 50), 3, 10, "petal_width", 1.75),
    (3, (0, 49, 5), 4, 7, "petal_length", 4.95),
    (4, (0, 47, 1), 5, 6, "petal_width", 1.65),
    (5, (0, 47, 0), None, None, None, None),
    (6, (0, 0, 1), None, None, None, None),
    (7, (0, 2, 4), 8, 9, "petal_width", 1.55),
    (8, (0, 0, 3), None, None, None, None),
    (9, (0, 2, 1), None, None, None, None),
    (10, (0, 1, 45), 11, 14, "petal_length", 4.85),
    (11, (0, 1, 2), 12, 13, "sepal_width", 3.1),
    (12, (0, 0, 2), None, None, None, None),
    (13, (0, 1, 0), None, None, None, None),
    (14, (0, 0, 43), None, None, None, None),
]
CLASSES = ["setosa", "versicolor", "virginica"]
FEATURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


def fixed_tree() -> Tree:
    return Tree([Node(i, list(c), l, r, f, t) for i, c, l, r, f, t in FIXED_NODES], CLASSES, FEATURES)


def event_features(t):
    """Four measurements per event, scaled into the tree's ranges."""
    ev = t.events
    return ev.select("event_id",
                     (F.hour("ts") / 3.0).alias("sepal_length"),
                     (F.col("user_id") / 30.0).alias("sepal_width"),
                     (F.col("value") / 70.0).alias("petal_length"),
                     (F.get_json_object("props", "$.k").cast("double") / 40.0).alias("petal_width"))


def _nodes_sql() -> str:
    rows = []
    for i, (a, b, c), l, r, f, t in FIXED_NODES:
        rows.append(f"({i}, {a}, {b}, {c}, {'NULL' if l is None else l}, {'NULL' if r is None else r}, "
                    f"{'NULL' if f is None else repr(f)}, {'NULL' if t is None else f'CAST({t} AS DOUBLE)'})")
    return ",\n  ".join(rows)


_TREE_SQL = f"""RECURSIVE nodes(id, n0, n1, n2, lft, rgt, feature, thr) AS (VALUES
  {_nodes_sql()}),
t(node, feats, thrs, dirs, ratios) AS (
  SELECT 0, CAST([] AS VARCHAR[]), CAST([] AS DOUBLE[]), CAST([] AS INTEGER[]), CAST([] AS DOUBLE[])
  UNION ALL
  SELECT c.id, list_append(t.feats, p.feature), list_append(t.thrs, p.thr),
         list_append(t.dirs, CASE WHEN c.id = p.lft THEN 0 ELSE 1 END),
         list_append(t.ratios, (c.n0 + c.n1 + c.n2) / (p.n0 + p.n1 + p.n2))
  FROM t JOIN nodes p ON p.id = t.node JOIN nodes c ON c.id = p.lft OR c.id = p.rgt),
leaves AS (SELECT t.node AS leaf, n.n0 / (n.n0 + n.n1 + n.n2) AS v0, n.n1 / (n.n0 + n.n1 + n.n2) AS v1,
                  n.n2 / (n.n0 + n.n1 + n.n2) AS v2, feats, thrs, dirs, ratios
           FROM t JOIN nodes n ON n.id = t.node WHERE n.lft IS NULL),
splits AS (SELECT leaf, v0, v1, v2, unnest(feats) AS feature, unnest(thrs) AS thr, unnest(dirs) AS dir,
                  unnest(ratios) AS ratio FROM leaves),
x AS (SELECT event_id, hour(ts) / 3.0 AS sepal_length, user_id / 30.0 AS sepal_width, value / 70.0 AS petal_length,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 40.0 AS petal_width FROM events),
xl AS (SELECT event_id, 'sepal_length' AS feature, sepal_length AS val FROM x
       UNION ALL SELECT event_id, 'sepal_width', sepal_width FROM x
       UNION ALL SELECT event_id, 'petal_length', petal_length FROM x
       UNION ALL SELECT event_id, 'petal_width', petal_width FROM x),
fidx(feature, idx) AS (VALUES ('sepal_length', 0), ('sepal_width', 1), ('petal_length', 2), ('petal_width', 3))"""


ORACLE_SCORE_SQL = f"""
WITH {_TREE_SQL},
hold AS (SELECT xl.event_id, s.leaf, any_value(s.v0) AS v0, any_value(s.v1) AS v1, any_value(s.v2) AS v2,
                bool_and(CASE WHEN s.dir = 0 THEN xl.val <= s.thr ELSE xl.val > s.thr END) AS ok
         FROM splits s JOIN xl ON xl.feature = s.feature GROUP BY xl.event_id, s.leaf)
SELECT event_id, leaf,
       CASE WHEN v0 >= v1 AND v0 >= v2 THEN 'setosa' WHEN v1 >= v2 THEN 'versicolor' ELSE 'virginica' END
         AS prediction
FROM hold WHERE ok
"""


@register("tree_score_fixed", ORACLE_SCORE_SQL)
def tree_score_fixed(spark, sf_dir):
    """M6: leaf and predicted class per event (one CASE expression, no join)."""
    return predict(event_features(Tables(spark, sf_dir)), fixed_tree()).select("event_id", "leaf", "prediction")


_SHAP_SQL = f"""{_TREE_SQL},
fs AS (SELECT xl.event_id, m.mask, s.leaf, any_value(s.v0) AS v0, any_value(s.v1) AS v1, any_value(s.v2) AS v2,
              product(CASE WHEN (m.mask >> fi.idx) & 1 = 1
                           THEN CASE WHEN (s.dir = 0 AND xl.val <= s.thr) OR (s.dir = 1 AND xl.val > s.thr)
                                     THEN 1.0 ELSE 0.0 END
                           ELSE s.ratio END) AS w
       FROM splits s JOIN fidx fi ON fi.feature = s.feature JOIN xl ON xl.feature = s.feature
       CROSS JOIN range(16) m(mask)
       GROUP BY xl.event_id, m.mask, s.leaf),
fsum AS (SELECT event_id, mask, sum(v0 * w) AS f0, sum(v1 * w) AS f1, sum(v2 * w) AS f2 FROM fs GROUP BY ALL),
wt(s, weight) AS (VALUES (0, 1.0 / 4), (1, 1.0 / 12), (2, 1.0 / 12), (3, 1.0 / 4)),
phi AS (SELECT a.event_id, fi.feature,
               sum(wt.weight * (b.f0 - a.f0)) AS p0, sum(wt.weight * (b.f1 - a.f1)) AS p1,
               sum(wt.weight * (b.f2 - a.f2)) AS p2
        FROM fsum a JOIN fidx fi ON (a.mask >> fi.idx) & 1 = 0
        JOIN fsum b ON b.event_id = a.event_id AND b.mask = a.mask | (1 << fi.idx)
        JOIN wt ON wt.s = bit_count(a.mask)
        GROUP BY a.event_id, fi.feature),
vals AS (SELECT event_id, 'setosa' AS class, feature, round(p0, 10) AS phi FROM phi
         UNION ALL SELECT event_id, 'versicolor', feature, round(p1, 10) FROM phi
         UNION ALL SELECT event_id, 'virginica', feature, round(p2, 10) FROM phi)"""


@register("tree_shap_fixed", f"WITH {_SHAP_SQL}\nSELECT event_id, class, feature, phi FROM vals")
def tree_shap_fixed(spark, sf_dir):
    """M9: path-dependent Shapley value per (event, class, feature)."""
    return shap_values(event_features(Tables(spark, sf_dir)), fixed_tree(), ["event_id"])


@register("shap_report", f"""WITH {_SHAP_SQL},
m AS (SELECT class, feature, round(avg(phi), 10) AS mean_shap FROM vals GROUP BY ALL)
SELECT class, feature, mean_shap,
       CASE WHEN mean_shap > 1e-12 THEN 'toward' WHEN mean_shap < -1e-12 THEN 'away' ELSE 'neutral' END AS direction,
       CAST(row_number() OVER (PARTITION BY class ORDER BY abs(mean_shap), feature) AS INTEGER) AS rank
FROM m
""")
def shap_report_query(spark, sf_dir):
    """Mean value per class and feature, direction, rank by magnitude."""
    return shap_report(shap_values(event_features(Tables(spark, sf_dir)), fixed_tree(), ["event_id"]))
