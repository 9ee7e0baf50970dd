"""Sinks written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.operators import sampling
from petalframe.plans import features_events as fe
from petalframe.plans.registry import register
from petalframe.session import work_dir
from petalframe.sources import io

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("csv_round_trip", "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    """Customers written as CSV with a header, loaded through the guard with an explicit schema."""
    path = work_dir(spark, "csv")
    names = [c.split()[0] for c in _CUSTOMER.split(", ")]
    io.write_csv(io.Tables(spark, sf_dir).customer.select(*names), path)
    return io.guarded_load(spark, path, "csv_round_trip", "csv", _CUSTOMER)


@register("csv_scan", "SELECT n_name, count(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name")
def csv_scan(spark, sf_dir):
    """Nations from a CSV file, joined to the customers' parquet."""
    t, path = io.Tables(spark, sf_dir), work_dir(spark, "nation-csv")
    io.write_csv(t.nation.select("n_nationkey", "n_name"), path)
    nation = io.read_csv(spark, path, "n_nationkey int, n_name string")
    customers = t.customer.select(F.col("c_nationkey").alias("n_nationkey"))
    return customers.join(nation, "n_nationkey").groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


@register("served_log", """
WITH s AS (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS basket FROM events WHERE event_type = 'click')
SELECT event_id, user_id, ts, basket, CAST(ts AS DATE) AS log_date, ts + INTERVAL 1 SECOND AS served_at
FROM s WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def served_log(spark, sf_dir):
    """Clicks logged as served, in two appends, with the time of serving; ten days read back."""
    path = work_dir(spark, "served")
    clicks = fe.click_spine(spark, sf_dir).select("event_id", "user_id", "ts", "basket")
    for half in (0, 1):
        io.log_served_features(clicks.where(F.pmod("event_id", F.lit(2)) == half), path, "ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    return io.read_served_log(spark, path, "2024-01-10", "2024-01-20")


@register("inline_lookup", """
WITH w AS (SELECT * FROM (VALUES ('1-URGENT', 3), ('2-HIGH', 2), ('5-LOW', 0)) w(o_orderpriority, weight))
SELECT o_orderpriority, coalesce(weight, 1) AS weight, count(*) AS orders FROM orders LEFT JOIN w USING (o_orderpriority) GROUP BY ALL
""")
def inline_lookup(spark, sf_dir):
    """An in-line table of weights joined to all orders."""
    w = io.inline_table(spark, [("1-URGENT", 3), ("2-HIGH", 2), ("5-LOW", 0)], "o_orderpriority string, weight int")
    o = io.Tables(spark, sf_dir).orders.select("o_orderpriority").join(w, "o_orderpriority", "left")
    return o.groupBy("o_orderpriority", F.coalesce("weight", F.lit(1)).alias("weight")).agg(F.count(F.lit(1)).alias("orders"))


@register("level_family", "SELECT c_custkey, c_acctbal, CAST(5 AS INTEGER) AS poisoning_level FROM customer")
def level_family(spark, sf_dir):
    """Copies of the customers at four levels in one partitioned table; one level read back."""
    path = work_dir(spark, "levels")
    c = io.Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    levels = c.withColumn("poisoning_level", F.explode(F.array(*[F.lit(x) for x in (0, 5, 10, 50)])))
    io.write_parquet(levels, path, ["poisoning_level"])
    return io.read_level(spark, path, 5)


@register("ingest_time", """
SELECT o_orderkey, TIMESTAMP '2024-02-01 00:00:00' AS ingest_timestamp, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_id FROM orders
""")
def ingest_time(spark, sf_dir):
    """Orders with a given ingest time and a dense row id."""
    o = io.Tables(spark, sf_dir).orders.select("o_orderkey")
    o = io.with_ingest_time(o, at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return sampling.surrogate_key(o, ["o_orderkey"])
