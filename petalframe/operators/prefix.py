"""Running totals over ordered rows, in two levels.

A window over a whole table, or over one hot group, runs in one task. Here the
rows are range partitioned by (group, order) - a sample of the whole sort key
sets the bounds, so a hot group spans several ranges - and written once with
the number of their range. Inside a range a task adds up as it streams its
sorted rows. What lies before a range is a sum over the totals of earlier
ranges: one row per range and group, summed in blocks first, so even that
window sees ranges / ``BLOCK`` rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.session import bounded_broadcast, materialize

#: Ranges whose totals one window takes.
BLOCK = 1024


def ranged(df: DataFrame, order: list, ranges: int | None = None) -> DataFrame:
    """``df`` in sorted ranges of ``order`` (as many as shuffle partitions, by default)."""
    r = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return r.sortWithinPartitions(*order)


def _same(by: list) -> Column:
    return F.lit(True) if not by else _all(F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in by)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def offsets(totals: DataFrame, by: list, sums: list, rng: str = "_range") -> DataFrame:
    """``(by, range, sums)`` to the sums of all earlier ranges of the group
    (``before_<sum>``) and of the whole group (``all_<sum>``)."""
    t = totals.withColumn("_block", F.floor(F.col(rng) / BLOCK))
    blocks = t.groupBy(*by, "_block").agg(*[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*by)
    w = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*[F.col(c).alias(f"_o_{c}") for c in by], F.col("_block").alias("_o_block"),
                           *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_b_{s}") for s in sums],
                           *[F.sum(s).over(group).alias(f"all_{s}") for s in sums])
    w = Window.partitionBy(*by, "_block").orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({f"_w_{s}": F.coalesce(F.sum(s).over(w), F.lit(0)) for s in sums})
    t = t.join(blocks, _same(by) & (F.col("_block") == F.col("_o_block")))
    return t.select(*by, rng, *[(F.col(f"_b_{s}") + F.col(f"_w_{s}")).alias(f"before_{s}") for s in sums], *[f"all_{s}" for s in sums])


def _with_offsets(rows: DataFrame, by: list, values: dict) -> DataFrame:
    totals = rows.groupBy(*by, "_range").agg(*[F.sum(v).alias(out) for out, v in values.items()])
    off, _ = bounded_broadcast(offsets(totals, by, list(values)))  # one row per range and group in it
    off = off.withColumnsRenamed({c: f"_o_{c}" for c in by} | {"_range": "_o_range"})
    return rows.join(off, _same(by) & (F.col("_range") == F.col("_o_range"))).drop("_o_range", *[f"_o_{c}" for c in by])


def positions(df: DataFrame, order: list, out: str, ranges: int | None = None, total: str | None = None) -> DataFrame:
    """``out``: 0-based place of every row in ``order`` (``total``: the number of rows).
    The order must be total for the places to be reproducible."""
    r = ranged(df, order, ranges)
    first = F.shiftleft(F.spark_partition_id().cast("long"), 33)
    r = materialize(r.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id() - first), "ranges")
    r = _with_offsets(r, [], {"_rows": F.lit(1).cast("long")})
    r = r.withColumn(out, F.col("before__rows") + F.col("_place"))
    if total:
        r = r.withColumn(total, F.col("all__rows"))
    return r.select(*df.columns, out, *([total] if total else []))


def changes(batch, by: list) -> np.ndarray:
    """True where a row's group differs from the row before it."""
    out = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for c in by:
        col = batch.column(c)
        a, b = col[1:], col[:-1]
        differ = pc.fill_null(pc.not_equal(a, b), False)
        out |= pc.or_(differ, pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    return out


def prefix_sums(df: DataFrame, order: list, values: dict, by: list = (), ranges: int | None = None) -> DataFrame:
    """For every ``out: column`` of ``values`` (long or double, NULL counts as 0):
    ``out``, the sum up to and including each row, in ``order`` within ``by``;
    and ``all_<out>``, the sum over the whole group."""
    by = list(by)
    r = ranged(df, [*by, *order], ranges)
    floats = {o: isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) for o, c in values.items()}
    added = [T.StructField(o, T.DoubleType() if f else T.LongType()) for o, f in floats.items()] + [T.StructField("_range", T.IntegerType())]

    def run(batches):
        task, last, carry = TaskContext.get().partitionId(), None, {o: 0 for o in values}
        for b in batches:
            if not b.num_rows:
                continue
            key = [b.column(c)[0].as_py() for c in by]
            start = np.concatenate([[last is None or key != last], changes(b, by)])
            last = [b.column(c)[-1].as_py() for c in by]
            group = np.maximum.accumulate(np.where(start, np.arange(b.num_rows), -1))  # first row of the row's group; -1: an earlier batch
            cols = []
            for o, c in values.items():
                v = pc.fill_null(b.column(c), 0).to_numpy(zero_copy_only=False).astype("float64" if floats[o] else "int64")
                total = np.cumsum(v)
                before = np.where(group > 0, total[group - 1], 0)
                run = total - before + np.where(group < 0, carry[o], 0)
                carry[o] = run[-1].item()
                cols.append(pa.array(run))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols, pa.array(np.full(b.num_rows, task, dtype="int32"))],
                                             [*b.schema.names, *values, "_range"])

    r = materialize(r.mapInArrow(run, T.StructType([*df.schema.fields, *added])), "ranges")
    inside = list(values)
    r = r.withColumnsRenamed({o: f"_in_{o}" for o in inside})
    r = _with_offsets(r, by, {o: F.coalesce(F.col(c), F.lit(0)) for o, c in values.items()})
    return r.select(*df.columns, *[(F.col(f"before_{o}") + F.col(f"_in_{o}")).alias(o) for o in inside], *[f"all_{o}" for o in inside])
