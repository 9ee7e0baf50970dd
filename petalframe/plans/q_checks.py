"""Data-check, validation and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from petalframe.defs import Field
from petalframe.operators import checks
from petalframe.plans.registry import register
from petalframe.sources.io import Tables

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_RANGES = {"c_acctbal": (-1000, 10000), "c_nationkey": (0, 24)}
ORDER_RANGES = {"o_totalprice": (1000, 450000), "o_orderkey": (1, 60000)}
FLOAT_COLS = {"c_acctbal", "o_totalprice"}


def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in FLOAT_COLS else f"({c} IS NULL)"


def _range_fail_sql(c: str, lo, hi) -> str:
    nan = f" AND NOT isnan({c})" if c in FLOAT_COLS else ""
    return f"CASE WHEN coalesce({c} BETWEEN {lo} AND {hi}{nan}, false) THEN 0 ELSE 1 END"


def _dataset_checks_sql() -> str:
    miss = " OR ".join(_missing_sql(c) for c in CUSTOMER_COLUMNS)
    rng = ",\n       ".join(f"sum({_range_fail_sql(c, lo, hi)}) AS r{i}"
                          for i, (c, (lo, hi)) in enumerate(CUSTOMER_RANGES.items()))
    parts = [f"SELECT 'no_missing_cells' AS \"check\", coalesce(m, 0) = 0 AS passed, "
             f"CAST(coalesce(m, 0) AS BIGINT) AS failed_rows FROM a"]
    for i, (c, (lo, hi)) in enumerate(CUSTOMER_RANGES.items()):
        parts.append(f"SELECT 'range:{c}:[{lo},{hi}]', coalesce(r{i}, 0) = 0, CAST(coalesce(r{i}, 0) AS BIGINT) FROM a")
    parts.append("SELECT 'columns_present', true, CAST(0 AS BIGINT)")
    return (f"WITH a AS (SELECT sum(CASE WHEN {miss} THEN 1 ELSE 0 END) AS m,\n       {rng} FROM customer)\n"
            + "\nUNION ALL ".join(parts))


@register("dataset_checks", _dataset_checks_sql())
def dataset_checks(spark, sf_dir):
    """Missing cells, expected columns and ranges in one pass over customer."""
    c = Tables(spark, sf_dir).customer
    return checks.check_suite(c, expected=CUSTOMER_COLUMNS, ranges=CUSTOMER_RANGES)


@register("range_checks", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
    f"coalesce(sum({_range_fail_sql(c, lo, hi)}), 0) = 0 AS passed, "
    f"CAST(coalesce(sum({_range_fail_sql(c, lo, hi)}), 0) AS BIGINT) AS failed_rows FROM orders"
    for c, (lo, hi) in ORDER_RANGES.items()))
def range_checks(spark, sf_dir):
    """Inclusive range checks over orders (NULL/NaN fail, empty passes)."""
    return checks.range_checks(Tables(spark, sf_dir).orders, ORDER_RANGES)


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("missing_cells", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {_missing_sql(c)} THEN 1 ELSE 0 END) AS BIGINT) AS n_missing "
    f"FROM orders" for c in _ORDER_COLS))
def missing_cells(spark, sf_dir):
    """NULL (and NaN for floats) per column of orders, one pass."""
    return checks.missing_cells(Tables(spark, sf_dir).orders.select(*_ORDER_COLS))


@register("column_ranges", """
SELECT min(p_size) AS min_p_size, max(p_size) AS max_p_size,
       min(p_retailprice) AS min_p_retailprice, max(p_retailprice) AS max_p_retailprice FROM part
""")
def column_ranges(spark, sf_dir):
    """A2: min / max per column in one aggregate."""
    return checks.column_ranges(Tables(spark, sf_dir).part, ["p_size", "p_retailprice"])


@register("distinct_classes", """
SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS class_index,
       count(*) OVER () AS n_classes
FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)
""")
def distinct_classes(spark, sf_dir):
    """A3/A4: sorted distinct labels, their index and count."""
    return checks.distinct_classes(Tables(spark, sf_dir).events, "event_type")


@register("standardize", """
SELECT p_partkey,
  round((p_size - avg(p_size) OVER ()) / CASE WHEN stddev_pop(p_size) OVER () = 0 THEN 1
        ELSE stddev_pop(p_size) OVER () END, 8) AS p_size_z,
  round((p_retailprice - avg(p_retailprice) OVER ()) / CASE WHEN stddev_pop(p_retailprice) OVER () = 0 THEN 1
        ELSE stddev_pop(p_retailprice) OVER () END, 8) AS p_retailprice_z
FROM part
""")
def standardize(spark, sf_dir):
    """M1/A10: z-scores with population deviation (fit = one aggregate row)."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_size", "p_retailprice")
    stats = checks.standard_scaler_fit(p, ["p_size", "p_retailprice"])
    return checks.standard_scaler_transform(p, stats, "_z", digits=8).select("p_partkey", "p_size_z", "p_retailprice_z")


@register("schema_validation_rejects", """
SELECT event_id, CAST(value AS FLOAT) AS value,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       NOT (props IS NOT NULL AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL) AS accepted
FROM events
""")
def schema_validation_rejects(spark, sf_dir):
    """Typed ingest of events (value FLOAT, props JSON {k INT}); rejects flagged."""
    ev = Tables(spark, sf_dir).events.select("event_id", "value", "props")
    ok, bad = checks.validate(ev, [Field("value", "float"), Field("props", "string")], {"props": "k INT"})
    ok = ok.select("event_id", "value", F.col("props.k").alias("k"), F.lit(True).alias("accepted"))
    bad = bad.select("event_id", F.col("value").cast("float").alias("value"), F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                     F.lit(False).alias("accepted"))
    return ok.unionByName(bad)


@register("json_field_checks", """
WITH r AS (
  SELECT event_id, event_id % 7 IN (0, 2) AS bad_props, event_id % 5 = 0 AS bad_amount,
    CASE CAST(event_id % 7 AS INTEGER)
    WHEN 0 THEN '{"k": "n' || CAST(user_id AS VARCHAR) || '", "kind": "' || event_type || '"}'
    WHEN 1 THEN '{"kind": "' || event_type || '"}' WHEN 2 THEN 'not json ' || CAST(event_id AS VARCHAR) WHEN 3 THEN '{}'
    ELSE '{"k": ' || json_extract_string(props, '$.k') || ', "kind": "' || event_type || '"}' END AS props,
    event_type, json_extract_string(props, '$.k') AS k0, user_id, value
  FROM events)
SELECT event_id, NOT (bad_props OR bad_amount) AS accepted, CASE WHEN bad_props OR bad_amount THEN props END AS raw_props,
  CASE WHEN NOT (bad_props OR bad_amount) AND event_id % 7 NOT IN (1, 3) THEN CAST(k0 AS INTEGER) END AS k,
  CASE WHEN NOT (bad_props OR bad_amount) AND event_id % 7 <> 3 THEN event_type END AS kind,
  CASE WHEN NOT (bad_props OR bad_amount) THEN CAST(floor(value) AS BIGINT) END AS amount,
  CASE WHEN bad_props OR bad_amount THEN CAST(bad_props AS INTEGER) + CAST(bad_amount AS INTEGER) END AS faults,
  CASE WHEN event_id % 7 = 0 THEN 'props.k: ' || chr(39) || 'n' || CAST(user_id AS VARCHAR) || chr(39) || ' is not INT'
       WHEN event_id % 7 = 2 THEN 'props: ' || chr(39) || props || chr(39) || ' is not A JSON OBJECT' END AS props_fault
FROM r
""")
def json_field_checks(spark, sf_dir):
    """K6: events whose props are broken in part (a text for a number, no object, a
    field left out) and whose amounts carry a unit: rejects keep the raw text and
    say which field is at fault."""
    ev = Tables(spark, sf_dir).events
    broken = F.pmod("event_id", F.lit(7))
    k, kind = F.get_json_object("props", "$.k"), F.concat(F.lit('"kind": "'), "event_type", F.lit('"}'))
    props = (F.when(broken == 0, F.concat(F.lit('{"k": "n'), F.col("user_id").cast("string"), F.lit('", '), kind))
             .when(broken == 1, F.concat(F.lit("{"), kind)).when(broken == 2, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
             .when(broken == 3, F.lit("{}")).otherwise(F.concat(F.lit('{"k": '), k, F.lit(", "), kind)))
    amount = F.when(F.pmod("event_id", F.lit(5)) == 0, F.concat(F.col("value").cast("string"), F.lit("ms"))).otherwise(
        F.floor("value").cast("string"))
    rows = ev.select("event_id", props.alias("props"), amount.alias("amount"))
    ok, bad = checks.validate(rows, [Field("amount", "bigint"), Field("props", "string")], {"props": "k INT, kind STRING"})
    none = F.lit(None)
    ok = ok.select("event_id", F.lit(True).alias("accepted"), none.cast("string").alias("raw_props"), F.col("props.k").alias("k"),
                   F.col("props.kind").alias("kind"), "amount", none.cast("int").alias("faults"), none.cast("string").alias("props_fault"))
    faults = F.split("reason", "; ")
    bad = bad.select("event_id", F.lit(False).alias("accepted"), F.col("props").alias("raw_props"), none.cast("int").alias("k"),
                     none.cast("string").alias("kind"), none.cast("bigint").alias("amount"), F.size(faults).alias("faults"),
                     F.try_element_at(F.filter(faults, lambda x: x.startswith("props")), F.lit(1)).alias("props_fault"))
    return ok.unionByName(bad)


@register("json_map_struct", """
WITH e AS (SELECT event_id, user_id, event_type,
                  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, k,
       to_json({'event_type': event_type, 'k': k}) AS props_json,
       map(['type', 'user'], [event_type, CAST(user_id AS VARCHAR)])['type'] AS map_type,
       {'id': user_id, 'kind': event_type}.kind AS struct_kind,
       ['z' || CAST(k AS VARCHAR), 'u' || CAST(user_id AS VARCHAR)][2] AS config_zone,
       CAST(k AS INTEGER) AS config_max_km
FROM e
""")
def json_map_struct(spark, sf_dir):
    """JSON path, JSON encode, map and struct literal/access, array inside JSON."""
    ev = Tables(spark, sf_dir).events
    k = F.get_json_object("props", "$.k").cast("int")
    cfg = F.to_json(F.struct(k.alias("max_distance_km"),
                             F.array(F.concat(F.lit("z"), k.cast("string")),
                                     F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("preferred_zones")))
    parsed = F.from_json(cfg, "max_distance_km INT, preferred_zones ARRAY<STRING>")
    return ev.select(
        "event_id", k.alias("k"),
        F.to_json(F.struct("event_type", k.alias("k"))).alias("props_json"),
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
        .getItem("type").alias("map_type"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).getField("kind").alias("struct_kind"),
        F.element_at(parsed.getField("preferred_zones"), 2).alias("config_zone"),
        parsed.getField("max_distance_km").alias("config_max_km"))
