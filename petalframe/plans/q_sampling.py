"""Sampling and randomisation queries: R1, R3, R6, R8, P14."""

from __future__ import annotations

from petalframe.functions.rand import sql_hash_rank, sql_uniform
from petalframe.operators import sampling
from petalframe.plans.registry import register
from petalframe.sources.io import Tables

SPLIT_SEED = 42


@register("stratified_split", f"""
WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS nn, CAST(ceil(sum(n) OVER () * CAST(0.4 AS DOUBLE)) AS BIGINT) AS tt FROM c),
q0 AS (SELECT *, (n * tt) % nn AS fr, ((n * tt) - (n * tt) % nn) // nn AS fl FROM t),
q1 AS (SELECT *, tt - sum(fl) OVER () AS rem,
              row_number() OVER (ORDER BY fr DESC, c_mktsegment) AS pos FROM q0),
q AS (SELECT c_mktsegment, fl + CASE WHEN pos <= rem THEN 1 ELSE 0 END AS k FROM q1),
r AS (SELECT c_custkey, c_mktsegment, c_acctbal,
             row_number() OVER (PARTITION BY c_mktsegment
                                ORDER BY {sql_hash_rank(SPLIT_SEED, 'split', 'c_custkey')}, c_custkey) AS rn
      FROM customer)
SELECT r.c_custkey, r.c_mktsegment, r.c_acctbal,
       CASE WHEN r.rn <= q.k THEN 'test' ELSE 'train' END AS split
FROM r JOIN q USING (c_mktsegment)
""")
def stratified_split(spark, sf_dir):
    """Exact 40 % test split of customers, stratified by segment."""
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return sampling.stratified_split(c, "c_custkey", "c_mktsegment", 0.4, SPLIT_SEED)


@register("sample_exact_k", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
QUALIFY row_number() OVER (ORDER BY {sql_hash_rank(7, 'pick', 'o_orderkey')}, o_orderkey)
        <= (SELECT round_even(count(*) * CAST(10 AS DOUBLE) / 100, 0) FROM orders)
""")
def sample_exact_k(spark, sf_dir):
    """Exactly round(n * 10 / 100) orders without replacement."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.sample_exact_k(o, "o_orderkey", 10, seed=7).where("sampled").drop("sampled")


def _poison_sql(level: int) -> str:
    seed = SPLIT_SEED + level
    u_val = sql_uniform(seed, "feat:value", "e.event_id")
    u_lab = sql_uniform(seed, "label", "e.event_id")
    return f"""
WITH st AS (SELECT min(value) AS lo, max(value) AS hi, list_sort(list(DISTINCT event_type)) AS cls,
                   round_even(count(*) * CAST({level} AS DOUBLE) / 100, 0) AS k FROM events),
r AS (SELECT e.*, row_number() OVER (ORDER BY {sql_hash_rank(seed, 'pick', 'e.event_id')}, e.event_id) AS rn
      FROM events e)
SELECT e.event_id, e.user_id,
       CASE WHEN e.rn <= st.k THEN st.lo + {u_val.replace('e.event_id', 'e.event_id')} * (st.hi - st.lo)
            ELSE e.value END AS value,
       CASE WHEN e.rn <= st.k
            THEN list_filter(st.cls, lambda x: x <> e.event_type)[CAST(floor({u_lab} * (len(st.cls) - 1)) AS INTEGER) + 1]
            ELSE e.event_type END AS event_type,
       CAST(CASE WHEN e.rn <= st.k THEN 1 ELSE 0 END AS INTEGER) AS is_poisoned
FROM r e CROSS JOIN st
"""


def _poison_query(level: int):
    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        ev = t.events.select("event_id", "user_id", "value", "event_type")
        return sampling.poison(ev, "event_id", ["value"], "event_type", level, SPLIT_SEED + level)

    run.__doc__ = f"R6: poison {level} % of events (feature value, label event_type)."
    return run


for _lvl in (5, 10, 50):
    register(f"poison_{_lvl}", _poison_sql(_lvl))(_poison_query(_lvl))


@register("balanced_groups", f"""
SELECT doc_id, lang,
       CAST((row_number() OVER (ORDER BY {sql_hash_rank(SPLIT_SEED, 'group', 'doc_id')}, doc_id) - 1) % 2 AS INTEGER)
         AS "group"
FROM documents
""")
def balanced_groups(spark, sf_dir):
    """Documents dealt 0, 1, 0, 1 ... over a keyed shuffle."""
    t = Tables(spark, sf_dir)
    return sampling.balanced_groups(t.documents.select("doc_id", "lang"), "doc_id", 2, SPLIT_SEED)


@register("surrogate_key", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders
""")
def surrogate_key(spark, sf_dir):
    """Dense 0-based ids in o_orderkey order, without a one-task window."""
    t = Tables(spark, sf_dir)
    return sampling.surrogate_key(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"])
