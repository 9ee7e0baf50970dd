"""Point-in-time retrieval queries over ``events`` and ``orders``."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from petalframe.operators import pit
from petalframe.plans.registry import register
from petalframe.sources.io import Tables


def _clicks(t):
    return t.events.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")


def _typed(t, kind, prefix):
    return (t.events.where(F.col("event_type") == kind)
            .select("user_id", "ts", F.col("value").alias(f"{prefix}_value"),
                    F.col("event_id").alias(f"{prefix}_event_id")))


_PIT_SQL = """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
f AS (SELECT user_id, ts AS f_ts, value AS purchase_value, event_id AS purchase_event_id
      FROM events WHERE event_type = 'purchase')
SELECT s.event_id, s.user_id, s.ts,
       CASE WHEN {ok} THEN f.purchase_value END AS purchase_value,
       CASE WHEN {ok} THEN f.purchase_event_id END AS purchase_event_id,
       CASE WHEN {ok} THEN f.f_ts END AS purchase_ts
FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.f_ts
"""


@register("pit_features_ttl", _PIT_SQL.format(ok="f.f_ts >= s.ts - INTERVAL 1 DAY"))
def pit_features_ttl(spark, sf_dir):
    """J1+J2: each click gets the user's newest purchase of the last day."""
    t = Tables(spark, sf_dir)
    return pit.as_of_join(_clicks(t), _typed(t, "purchase", "purchase"), ["user_id"],
                          ttl=timedelta(days=1), feature_ts_as="purchase_ts")


@register("pit_features_no_ttl", _PIT_SQL.format(ok="TRUE"))
def pit_features_no_ttl(spark, sf_dir):
    """J1 without ttl: newest purchase at or before each click, however old."""
    t = Tables(spark, sf_dir)
    return pit.as_of_join(_clicks(t), _typed(t, "purchase", "purchase"), ["user_id"],
                          feature_ts_as="purchase_ts")


@register("pit_created_tiebreak", """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
f0 AS (SELECT user_id, date_trunc('day', ts) AS f_day, ts AS created, value, event_id
       FROM events WHERE event_type IN ('purchase', 'view')),
f AS (SELECT * FROM f0 QUALIFY row_number() OVER (PARTITION BY user_id, f_day ORDER BY created DESC) = 1)
SELECT s.event_id, s.user_id, s.ts, f.value AS day_value, f.event_id AS day_event_id, f.f_day AS day_ts
FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.f_day
""")
def pit_created_tiebreak(spark, sf_dir):
    """Feature rows cut to the day collide; the newest ``created`` wins."""
    t = Tables(spark, sf_dir)
    f = (t.events.where(F.col("event_type").isin("purchase", "view"))
         .select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("f_day"),
                 F.col("ts").alias("created"), F.col("value").alias("day_value"),
                 F.col("event_id").alias("day_event_id")))
    return pit.as_of_join(_clicks(t), f, ["user_id"], feature_ts="f_day", created="created",
                          features=["day_value", "day_event_id"], feature_ts_as="day_ts")


@register("pit_multi_view", """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
p AS (SELECT user_id, ts AS p_ts, value AS purchase_value FROM events WHERE event_type = 'purchase'),
e AS (SELECT user_id, ts AS e_ts, value AS error_value FROM events WHERE event_type = 'error'),
sp AS (SELECT s.*, CASE WHEN p.p_ts >= s.ts - INTERVAL 1 DAY THEN p.purchase_value END AS purchase_value
       FROM s ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.ts >= p.p_ts)
SELECT sp.event_id, sp.user_id, sp.ts, sp.purchase_value, e.error_value
FROM sp ASOF LEFT JOIN e ON sp.user_id = e.user_id AND sp.ts >= e.e_ts
""")
def pit_multi_view(spark, sf_dir):
    """Two views onto one spine, one with ttl, one without."""
    t = Tables(spark, sf_dir)
    p = t.events.where(F.col("event_type") == "purchase").select("user_id", "ts", F.col("value").alias("purchase_value"))
    e = t.events.where(F.col("event_type") == "error").select("user_id", "ts", F.col("value").alias("error_value"))
    return pit.as_of_join(pit.as_of_join(_clicks(t), p, ["user_id"], ttl=timedelta(days=1)), e, ["user_id"])


@register("pit_batch_scoring", """
SELECT c.c_custkey, o.o_orderkey AS last_orderkey, o.o_totalprice AS last_totalprice,
       o.o_orderdate AS last_orderdate
FROM customer c
LEFT JOIN (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey
                                      ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
  ON c.c_custkey = o.o_custkey
""")
def pit_batch_scoring(spark, sf_dir):
    """Spine time = now, no ttl -> each customer's newest order."""
    t = Tables(spark, sf_dir)
    spine = pit.batch_scoring_spine(t.customer.select("c_custkey"), "now_ts",
                                    F.current_timestamp().cast("timestamp_ntz"))
    f = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate",
                        F.col("o_orderkey").alias("last_orderkey"),
                        F.col("o_totalprice").alias("last_totalprice"))
    # Orders carry no time of day, so a customer may have two on one date;
    # the larger order key breaks that tie (the created-time rule, J3).
    f = f.withColumn("_created", F.col("last_orderkey"))
    out = pit.as_of_join(spine, f, ["c_custkey"], spine_ts="now_ts", feature_ts="o_orderdate",
                         features=["last_orderkey", "last_totalprice"], created="_created",
                         feature_ts_as="last_orderdate")
    return out.drop("now_ts")
