"""Feature-store queries: services, on-demand views, materialisation, online
lookup, labels (K2-K8, J6-J8, P13, X1)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from petalframe.defs import Project
from petalframe.operators import online, pit
from petalframe.plans import features_events as fe
from petalframe.plans.registry import register
from petalframe.session import work_dir
from petalframe.sources.io import Tables

SLICE_1_END = "2024-01-15 12:00:00"
SLICE_2_END = "2024-01-31 00:00:00"
STORE_END = "2030-01-01 00:00:00"

_SPINE = """s AS (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS basket,
              CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 AS budget
       FROM events WHERE event_type = 'click')"""
_PURCH = """p AS (SELECT user_id, ts AS p_ts, value AS pv FROM events WHERE event_type = 'purchase')"""
_ERR = """e AS (SELECT user_id, ts AS e_ts, value AS error_value FROM events WHERE event_type = 'error')"""
_SP = """sp AS (SELECT s.*, CASE WHEN p.p_ts >= s.ts - INTERVAL 1 DAY THEN p.pv END AS purchase_value
        FROM s ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.ts >= p.p_ts)"""
_ODFV = """basket - purchase_value AS basket_gap, (basket + purchase_value) / budget AS budget_used"""


@register("feature_service_v1", f"""
WITH {_SPINE}, {_PURCH}, {_SP}
SELECT event_id, user_id, ts, basket, budget, purchase_value, {_ODFV} FROM sp
""")
def feature_service_v1(spark, sf_dir):
    """service = one sub-selected feature + an on-demand view."""
    d = fe.build(sf_dir)
    return pit.get_historical_features(fe.click_spine(spark, sf_dir), [d["basic"]], spine_ts="ts", spark=spark)


@register("feature_service_v2", f"""
WITH {_SPINE}, {_PURCH}, {_ERR}, {_SP},
spe AS (SELECT sp.*, e.error_value FROM sp ASOF LEFT JOIN e ON sp.user_id = e.user_id AND sp.ts >= e.e_ts)
SELECT event_id, user_id, ts, basket, budget, purchase_value, error_value, {_ODFV} FROM spe
""")
def feature_service_v2(spark, sf_dir):
    """service = two whole views + an on-demand view."""
    d = fe.build(sf_dir)
    return pit.get_historical_features(fe.click_spine(spark, sf_dir), [d["full"]], spine_ts="ts", spark=spark)


@register("feature_service_v3", f"""
WITH {_SPINE}, {_PURCH}, {_SP}
SELECT event_id, user_id, ts, basket, budget, purchase_value, {_ODFV} FROM sp
""")
def feature_service_v3(spark, sf_dir):
    """Service over the push-fed live view; offline retrieval reads its batch side."""
    d = fe.build(sf_dir)
    return pit.get_historical_features(fe.click_spine(spark, sf_dir), [d["following"]], spine_ts="ts", spark=spark)


@register("on_demand_features", f"""
WITH {_SPINE}, {_PURCH}, {_SP}
SELECT event_id, user_id, ts, basket, budget, {_ODFV} FROM sp
""")
def on_demand_features(spark, sf_dir):
    """Only the on-demand outputs are selected; their input feature is
    fetched and dropped. Runs the pandas (mapInPandas) variant."""
    d = fe.build(sf_dir)
    return pit.get_historical_features(fe.click_spine(spark, sf_dir), [d["signals_pandas"]], spine_ts="ts", spark=spark)


@register("materialize_incremental", f"""
SELECT user_id, arg_max(ts, ts) AS ts, arg_max(event_id, ts) AS event_id,
       arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
FROM events WHERE ts <= TIMESTAMP '{SLICE_2_END}' GROUP BY user_id
""")
def materialize_incremental(spark, sf_dir):
    """K2: first slice up to the 15th, then the increment up to the 31st merged
    into that snapshot; equal to one pass over everything up to the end."""
    ev = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", "event_type", "value")
    snap = online.materialize_frame(ev, None, ["user_id"], "ts", end=SLICE_1_END)
    return online.materialize_frame(ev, snap, ["user_id"], "ts", start=SLICE_1_END, end=SLICE_2_END)


@register("online_lookup", """
WITH latest AS (SELECT user_id, arg_max(value, ts) AS purchase_value, max(ts) AS purchase_ts
                FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT r.event_id AS req_id, r.user_id, l.purchase_value, l.purchase_ts
FROM events r LEFT JOIN latest l ON r.user_id = l.user_id
WHERE r.event_type = 'signup'
""")
def online_lookup(spark, sf_dir):
    """Every signup event asks for its user's latest purchase; users
    without purchases get NULL; repeated users are all answered."""
    ev = Tables(spark, sf_dir).events
    latest = online.latest_per_key(
        ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("purchase_ts"),
                                                           F.col("value").alias("purchase_value")),
        ["user_id"], "purchase_ts")
    req = ev.where(F.col("event_type") == "signup").select(F.col("event_id").alias("req_id"), "user_id")
    return online.online_lookup(req, latest, ["user_id"], ["purchase_value", "purchase_ts"])


_LATEST = """l AS (SELECT user_id, max(ts) AS l_ts, max(value) FILTER (WHERE newest) AS purchase_value
      FROM (SELECT *, ts = max(ts) OVER (PARTITION BY user_id) AS newest FROM events WHERE event_type = 'purchase') GROUP BY user_id)"""


def _stored(spark, sf_dir, *views):
    """A store with the views materialised in two increments."""
    store = online.OnlineStore(spark, work_dir(spark, "online"), buckets=8)
    for v in views:
        for end in (SLICE_1_END, STORE_END):
            store.materialize_incremental(v, datetime.fromisoformat(end))
    return store


@register("online_service_v1", f"""
WITH {_SPINE}, {_LATEST}, sp AS (SELECT s.*, l.purchase_value FROM s LEFT JOIN l USING (user_id))
SELECT event_id, user_id, ts, basket, budget, purchase_value, {_ODFV} FROM sp
""")
def online_service_v1(spark, sf_dir):
    """Clicks as online requests for a service: stored features, request
    columns and on-demand outputs; users without purchases get NULLs."""
    d = fe.build(sf_dir)
    store = _stored(spark, sf_dir, d["purchases"])
    return store.get_features(fe.click_spine(spark, sf_dir), [d["basic"]], order_col="event_id")


@register("online_service_v3", f"""
WITH {_SPINE}, {_LATEST}, {_ERR},
le AS (SELECT user_id, max(error_value) FILTER (WHERE newest) AS error_value
       FROM (SELECT *, e_ts = max(e_ts) OVER (PARTITION BY user_id) AS newest FROM e) GROUP BY user_id),
sp AS (SELECT s.*, l.purchase_value, le.error_value FROM s LEFT JOIN l USING (user_id) LEFT JOIN le USING (user_id))
SELECT event_id, user_id, ts, basket, budget, purchase_value, error_value, {_ODFV} FROM sp
""")
def online_service_v3(spark, sf_dir):
    """A push-fed view, another view and an on-demand view in one lookup plan."""
    d = fe.build(sf_dir)
    store = _stored(spark, sf_dir, d["errors"])
    store.push(d["live"], d["live"].batch_source.load(spark))
    return store.get_features(fe.click_spine(spark, sf_dir), [d["following"], d["errors"]])


@register("history_by_reference", f"""
WITH {_SPINE}, {_PURCH}, {_ERR}, {_SP}
SELECT sp.event_id, sp.user_id, sp.ts, sp.basket, sp.budget, sp.purchase_value, e.error_value, {_ODFV}
FROM sp ASOF LEFT JOIN e ON sp.user_id = e.user_id AND sp.ts >= e.e_ts
""")
def history_by_reference(spark, sf_dir):
    """Features named as strings, looked up among a project's definitions."""
    d = fe.build(sf_dir)
    project = Project("shop").apply([d["purchases"], d["errors"], d["signals"], d["basic"]])
    names = ["last_purchase:purchase_value", "last_error:error_value", "checkout_signals:basket_gap"]
    return pit.get_historical_features(fe.click_spine(spark, sf_dir), names, spine_ts="ts", spark=spark, project=project)


@register("latest_label_join", """
WITH l AS (SELECT user_id, ts AS labelled_at, CAST(event_type = 'purchase' AS BIGINT) AS in_good_standing, event_type AS reporter
           FROM events WHERE event_type IN ('purchase', 'error')
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1)
SELECT e.event_id, e.user_id, l.in_good_standing, l.reporter FROM events e LEFT JOIN l USING (user_id) WHERE e.event_type = 'signup'
""")
def latest_label_join(spark, sf_dir):
    """The newest label of the user onto every signup."""
    d = fe.build(sf_dir)
    ev = Tables(spark, sf_dir).events
    labels = (ev.where(F.col("event_type").isin("purchase", "error"))
              .select("user_id", F.col("ts").alias("event_timestamp"), (F.col("event_type") == "purchase").cast("long").alias("in_good_standing"),
                      F.col("event_type").alias("reporter")))
    spine = ev.where(F.col("event_type") == "signup").select("event_id", "user_id")
    return online.join_latest_labels(spine, labels, d["standing"]).select("event_id", "user_id", "in_good_standing", "reporter")


@register("label_last_write_wins", """
WITH l AS (SELECT user_id, ts AS event_timestamp, CAST(event_type = 'purchase' AS BIGINT) AS in_good_standing,
                  value AS amount, event_type AS reporter
           FROM events WHERE event_type IN ('purchase', 'error'))
SELECT user_id, event_timestamp, in_good_standing, amount, reporter, in_good_standing IN (0, 1) AS is_valid
FROM l QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, reporter DESC) = 1
""")
def label_last_write_wins(spark, sf_dir):
    """K7: purchase / error events as labels of standing; newest wins per user."""
    d = fe.build(sf_dir)
    ev = Tables(spark, sf_dir).events
    labels = (ev.where(F.col("event_type").isin("purchase", "error"))
              .select("user_id", F.col("ts").alias("event_timestamp"),
                      (F.col("event_type") == "purchase").cast("long").alias("in_good_standing"),
                      F.col("value").alias("amount"), F.col("event_type").alias("reporter")))
    return online.resolve_labels(labels, d["standing"])


@register("labels_left_join", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def labels_left_join(spark, sf_dir):
    """Documents (pruned to three columns) left join their labels."""
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
