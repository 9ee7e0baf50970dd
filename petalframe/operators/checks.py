"""Data checks and ingest validation: M12, A7, A8, U4, K6, A2-A4, M1, A10.

Each check suite is one aggregate pass over the table; the per-check rows are
produced by exploding the single result row, so adding checks adds columns to
one scan rather than more scans.

Contracts where pandas and Spark differ: a missing float cell is NULL *or*
NaN; "all values in [a, b]" is false for NULL/NaN cells and true on an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.operators.prefix import positions

_FLOATS = (T.FloatType, T.DoubleType)


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for float columns."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _FLOATS):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def in_range(df: DataFrame, c: str, lo, hi) -> Column:
    """P8 with the null contract: NULL / NaN -> False."""
    col = F.col(c)
    ok = col.between(lo, hi)
    if isinstance(df.schema[c].dataType, _FLOATS):
        ok = ok & ~F.isnan(col)
    return F.coalesce(ok, F.lit(False))


def missing_cells(df: DataFrame) -> DataFrame:
    """Missing cells per column, one pass, long format ``(column_name, n_missing)``."""
    aggs = [F.sum(is_missing(df, c).cast("long")).alias(c) for c in df.columns]
    wide = df.agg(*aggs).fillna(0)
    return wide.unpivot([], df.columns, "column_name", "n_missing")


def expected_columns(df: DataFrame, expected: list) -> list:
    """U4: names of expected columns missing from the schema (metadata only)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def check_suite(df: DataFrame, expected: list | None = None, ranges: dict | None = None,
                no_missing: bool = True) -> DataFrame:
    """``(check, passed, failed_rows)`` for: no missing cells, expected
    columns present, and each inclusive range; one aggregate pass."""
    items = []
    aggs = []
    if no_missing:
        any_missing = None
        for c in df.columns:
            m = is_missing(df, c)
            any_missing = m if any_missing is None else (any_missing | m)
        aggs.append(F.sum(any_missing.cast("long")).alias("_missing"))
        items.append(("no_missing_cells", "_missing"))
    for i, (c, (lo, hi)) in enumerate((ranges or {}).items()):
        aggs.append(F.sum((~in_range(df, c, lo, hi)).cast("long")).alias(f"_r{i}"))
        items.append((f"range:{c}:[{lo},{hi}]", f"_r{i}"))
    row = df.agg(*aggs) if aggs else df.sparkSession.range(1).select(F.lit(0).alias("_dummy"))
    structs = [F.struct(F.lit(name).alias("check"),
                        (F.coalesce(F.col(col), F.lit(0)) == 0).alias("passed"),
                        F.coalesce(F.col(col), F.lit(0)).cast("long").alias("failed_rows"))
               for name, col in items]
    if expected is not None:
        miss = len(expected_columns(df, expected))
        structs.append(F.struct(F.lit("columns_present").alias("check"), F.lit(miss == 0).alias("passed"),
                                F.lit(miss).cast("long").alias("failed_rows")))
    return row.select(F.explode(F.array(*structs)).alias("_c")).select("_c.*")


def range_checks(df: DataFrame, ranges: dict) -> DataFrame:
    """``(column_name, lo, hi, passed, failed_rows)``; empty table passes."""
    aggs = [F.sum((~in_range(df, c, lo, hi)).cast("long")).alias(f"_r{i}")
            for i, (c, (lo, hi)) in enumerate(ranges.items())]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                        (F.coalesce(F.col(f"_r{i}"), F.lit(0)) == 0).alias("passed"),
                        F.coalesce(F.col(f"_r{i}"), F.lit(0)).cast("long").alias("failed_rows"))
               for i, (c, (lo, hi)) in enumerate(ranges.items())]
    return row.select(F.explode(F.array(*structs)).alias("_c")).select("_c.*")


def column_ranges(df: DataFrame, cols: list) -> DataFrame:
    """A2: min and max of each column, one aggregate."""
    return df.agg(*[x for c in cols for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def distinct_classes(df: DataFrame, col: str) -> DataFrame:
    """A3/A4: sorted distinct non-null values with their 0-based position and
    the distinct count. Works on the distinct set (one row per class)."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return positions(d, [col], "class_index", total="n_classes").withColumn("class_index", F.col("class_index").cast("int"))


# ------------------------------------------------------------------ K6


def _sql_type(t: T.DataType) -> str:
    return t.simpleString().upper()


def _json_field(text: Column, t: T.DataType) -> Column:
    """A field's JSON text as its declared type; NULL where it does not convert."""
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, t)
    return text.try_cast(t)


def validate(df: DataFrame, fields: list, json_fields: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """K6: cast to the declared types with ``try_cast``. A JSON string column is
    parsed to the texts of its fields, and each declared field is converted on
    its own; a field that is absent or null is NULL.

    Returns (typed rows, rejects). A row is rejected if a value that is there
    does not convert. A reject keeps its columns as they came; ``reason`` says
    for every broken value where, what, and which type it is not, joined by ``; ``.
    """
    json_fields = json_fields or {}
    typed, bad = {}, []

    def check(place: str, text: Column, value: Column, dtype: str) -> None:
        told = F.concat(F.lit(f"{place}: '"), text.cast("string"), F.lit(f"' is not {dtype}"))
        bad.append(F.when(text.isNotNull() & value.isNull(), told))

    for f in fields:
        src = F.col(f.name)
        if f.name not in json_fields:
            typed[f.name] = src.try_cast(f.spark_type)
            check(f.name, src, typed[f.name], _sql_type(f.spark_type))
            continue
        jt = json_fields[f.name]
        jt = jt if isinstance(jt, T.DataType) else T.DataType.fromDDL(jt)
        if not isinstance(jt, T.StructType):
            typed[f.name] = F.from_json(src, jt)
            check(f.name, src, typed[f.name], _sql_type(jt))
            continue
        texts = F.from_json(src, "map<string,string>")
        check(f.name, src, texts, "A JSON OBJECT")
        parts = []
        for x in jt.fields:
            text = F.element_at(texts, F.lit(x.name))
            value = _json_field(text, x.dataType)
            check(f"{f.name}.{x.name}", text, value, _sql_type(x.dataType))
            parts.append(value.alias(x.name))
        typed[f.name] = F.when(texts.isNotNull(), F.struct(*parts))
    out = df.withColumn("_reject", F.filter(F.array(*bad), lambda x: x.isNotNull()))
    ok = out.where(F.size("_reject") == 0).drop("_reject").withColumns(typed)
    rejects = out.where(F.size("_reject") > 0).withColumn("reason", F.array_join("_reject", "; ")).drop("_reject")
    return ok, rejects


def standard_scaler_fit(df: DataFrame, cols: list) -> dict:
    """A10: population mean and deviation per column (one aggregate row,
    O(columns) values to the driver, like any model fit). Zero deviation
    scales by 1."""
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] if row[f"s_{c}"] else 1.0) for c in cols}


def standard_scaler_transform(df: DataFrame, stats: dict, suffix: str = "", digits: int | None = None) -> DataFrame:
    """M1: ``(x - mean) / std_pop`` with the fitted (train) statistics."""
    out = {}
    for c, (m, s) in stats.items():
        e = (F.col(c) - F.lit(m)) / F.lit(s)
        out[c + suffix] = F.round(e, digits) if digits is not None else e
    return df.withColumns(out)
