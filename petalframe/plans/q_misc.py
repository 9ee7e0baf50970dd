"""Small operators: newest partition, split metadata, shuffle order, head,
point lookup, scalar functions (S11, S13, R7, W3-W5, P7, F3, F5-F10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.functions import scalar
from petalframe.functions.rand import sql_hash_rank
from petalframe.operators import sampling
from petalframe.plans.q_sampling import SPLIT_SEED
from petalframe.plans.registry import register
from petalframe.sources import io
from petalframe.sources.io import Tables


@register("latest_partition", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
""")
def latest_partition(spark, sf_dir):
    """Rows of the newest value of a partition-like column."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return io.latest_partition(o, "o_orderdate")


@register("split_metadata", f"""
WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS nn, CAST(ceil(sum(n) OVER () * CAST(0.4 AS DOUBLE)) AS BIGINT) AS tt FROM c),
q0 AS (SELECT *, (n * tt) % nn AS fr, ((n * tt) - (n * tt) % nn) // nn AS fl FROM t),
q1 AS (SELECT *, tt - sum(fl) OVER () AS rem, row_number() OVER (ORDER BY fr DESC, c_mktsegment) AS pos FROM q0)
SELECT CAST(sum(n) AS INTEGER) AS total_samples,
       CAST(sum(n) - sum(fl + CASE WHEN pos <= rem THEN 1 ELSE 0 END) AS INTEGER) AS training_samples,
       CAST(sum(fl + CASE WHEN pos <= rem THEN 1 ELSE 0 END) AS INTEGER) AS test_samples,
       CAST({SPLIT_SEED} AS INTEGER) AS random_seed
FROM q1
""")
def split_metadata(spark, sf_dir):
    """Totals of the stratified customer split and its seed, one aggregate row."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    return io.run_metadata(sampling.stratified_split(c, "c_custkey", "c_mktsegment", 0.4, SPLIT_SEED), "split",
                           SPLIT_SEED)


@register("shuffle_rank", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash_rank(SPLIT_SEED, 'shuffle', 'o_orderkey')}, o_orderkey) - 1
         AS shuffle_pos
FROM orders
""")
def shuffle_rank(spark, sf_dir):
    """Position of every order in a reproducible keyed shuffle (no one-task window)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    return sampling.shuffle_positions(o, "o_orderkey", SPLIT_SEED, out="shuffle_pos")


@register("head_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def head_rows(spark, sf_dir):
    """The five most expensive orders (a top-k: the limit is the feature)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@register("row_lookup", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) + 49 FROM orders)
""")
def row_lookup(spark, sf_dir):
    """Point lookup by id (the equality reaches the parquet reader as a pushed filter)."""
    o = Tables(spark, sf_dir).orders
    first = o.agg(F.min("o_orderkey")).first()[0]
    return o.where(F.col("o_orderkey") == first + 49).select("o_orderkey", "o_custkey", "o_totalprice")


@register("scalar_functions", """
SELECT event_id, round(value, 2) AS latency_ms,
       format('{:.4f}', value) AS value_4,
       printf('%s_%d', event_type, user_id) AS tag,
       strftime(ts, '%Y%m%d_%H%M%S') AS run_name,
       (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000.0 AS ms_since_midnight
FROM events
""")
def scalar_functions(spark, sf_dir):
    """Rounding, number and string formatting, run names, durations."""
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", scalar.round_ms("value").alias("latency_ms"),
                     F.format_string("%.4f", "value").alias("value_4"),
                     F.format_string("%s_%d", "event_type", "user_id").alias("tag"),
                     scalar.run_name("ts").alias("run_name"),
                     scalar.duration_ms(F.date_trunc("day", "ts"), F.col("ts")).alias("ms_since_midnight"))


@register("url_hosts", """
SELECT split_part(url, '/', 3) AS host, split_part(split_part(url, '/', 4), '?', 1) AS first_part,
       count(*) AS pages
FROM pages GROUP BY ALL
""")
def url_hosts(spark, sf_dir):
    """host and first path segment of every page URL, counted."""
    p = Tables(spark, sf_dir).pages.select("url")
    path = F.split(F.col("url"), "/").getItem(3)
    return (p.select(scalar.url_host("url").alias("host"),
                     scalar.first_path_part(F.split(path, r"\?").getItem(0)).alias("first_part"))
            .groupBy("host", "first_part").agg(F.count(F.lit(1)).alias("pages")))
