"""Exact, reproducible sampling and randomisation: R1-R8, P14.

Every random choice is a keyed hash of (seed, salt, row key), see
:mod:`petalframe.functions.rand`, so results do not depend on partitioning,
retries or the engine.

"The k smallest hashes of each stratum" is the core of the split, the exact-k
sample and the poisoning. A ``row_number`` over each stratum would put each
stratum - possibly a third of all rows - into one task. Instead the leading
hex digits of the hash define ordered buckets: counting rows per (stratum,
bucket) is a partial aggregate; a running sum over those counts finds, per
stratum, the one bucket that holds the k-th row. Rows in earlier buckets are
selected outright, rows in later buckets are not, and only the rows of the
single boundary bucket (about n / 16**digits of them) are ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petalframe.functions.rand import hash_bucket, hash_rank, uniform
from petalframe.operators.prefix import positions
from petalframe.session import bounded_broadcast, materialize

DEFAULT_DIGITS = 4  # 16**4 = 65,536 buckets per stratum: a stratum of 1e12 rows ranks ~15M rows at its boundary


def _cols(cs) -> list:
    return [cs] if isinstance(cs, str) else list(cs or [])


def _join_null_safe(left: DataFrame, right: DataFrame, on: list, how: str = "inner") -> DataFrame:
    """Join on equal values, NULL equal to NULL; the left columns stay."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(named, cond, how).drop(*[f"_r_{c}" for c in on])


def select_k_smallest(df: DataFrame, rank: str, tiebreak: list, strata: list,
                      quota, digits: int = DEFAULT_DIGITS,
                      out: str = "_selected") -> DataFrame:
    """Flag the ``_k`` rows with the smallest ``(rank, *tiebreak)`` in each stratum.

    ``quota`` is a frame ``(strata..., _k)`` or a function from the
    per-stratum totals ``(strata..., _n)`` to such a frame (the totals then
    come from the bucket counts; no extra pass over ``df``).

    Three passes over ``df``, none of which shuffles its rows:

    1. counts per (stratum, hash bucket) - a partial aggregate, written once;
       a running sum over them finds each stratum's boundary bucket;
    2. only the rows of the boundary buckets are ranked, which gives the last
       selected ``(rank, *tiebreak)`` per stratum - one row per stratum;
    3. a narrow pass compares every row with its stratum's threshold.

    The per-stratum threshold table is written once, counted, and broadcast
    only below :data:`petalframe.session.BROADCAST_MAX_ROWS`.

    ``(rank, *tiebreak)`` must tell rows apart: rows that are equal in it on
    both sides of a threshold are an error, never one too many or too few.
    """
    strata = _cols(strata)
    const = not strata
    if const:  # one stratum: a constant column keeps the plan uniform
        df, strata = df.withColumn("_s0", F.lit(0)), ["_s0"]
        if not callable(quota):
            quota = quota.withColumn("_s0", F.lit(0))
    n_buckets = 16 ** digits
    b = df.withColumn("_bk", hash_bucket(F.col(rank), digits))
    counts = materialize(b.groupBy(*strata, "_bk").agg(F.count(F.lit(1)).alias("_n")))
    if callable(quota):
        quota = quota(counts.groupBy(*strata).agg(F.sum("_n").alias("_n")))
    quota = quota.select(*strata, "_k")
    running = Window.partitionBy(*strata).orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_cum", F.sum("_n").over(running))
    cum = _join_null_safe(cum, quota, strata)
    boundary = (cum.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_n") < F.col("_k")))
                .select(*strata, F.col("_bk").alias("_B"),
                        (F.col("_k") - (F.col("_cum") - F.col("_n"))).alias("_need")))
    # Strata with k <= 0 select nothing; strata with k >= n select everything.
    thr = (_join_null_safe(quota, boundary, strata, "left")
           .select(*strata,
                   F.coalesce(F.col("_B"), F.when(F.col("_k") <= 0, F.lit(-1)).otherwise(F.lit(n_buckets))).alias("_B"),
                   F.coalesce(F.col("_need"), F.lit(0)).alias("_need")))
    thr, _ = bounded_broadcast(thr)
    order = [F.col(rank)] + [F.col(c) for c in tiebreak]
    wb = Window.partitionBy(*strata).orderBy(*order)
    last = (_join_null_safe(b, thr, strata).where(F.col("_bk") == F.col("_B"))
            .withColumns({"_rn": F.row_number().over(wb), "_next": F.lead(F.struct(*order)).over(wb)}).where(F.col("_rn") == F.col("_need"))
            .select(*strata, F.struct(*order).alias("_last"), F.coalesce(F.col("_next") == F.struct(*order), F.lit(False)).alias("_again")))
    thr, _ = bounded_broadcast(_join_null_safe(thr, last, strata, "left"))
    again = thr.where("_again").select("_last").first()
    if again is not None:
        raise ValueError(f"keys must be unique: {tuple(again['_last'])[1:]} is repeated at the end of a selection")
    thr = thr.drop("_again")
    sel = (F.col("_bk") < F.col("_B")) | ((F.col("_bk") == F.col("_B")) & (F.struct(*order) <= F.col("_last")))
    res = _join_null_safe(b, thr, strata).withColumn(out, F.coalesce(sel, F.lit(False))).drop("_bk", "_B", "_need", "_last")
    return res.drop("_s0") if const else res


def split_quotas(counts: DataFrame, strata: list, fraction: float) -> DataFrame:
    """R1 quotas: test total ``ceil(n * f)``; each stratum gets the floor of its
    proportional share, the remainder goes to the largest fractional parts,
    ties to the smaller stratum value. Works on one row per stratum."""
    strata = _cols(strata)
    tot = int(counts.agg(F.sum("_n")).first()[0] or 0)
    test = math.ceil(tot * fraction)
    # Exact integer shares: floor = n*T div N, fraction numerator = n*T mod N.
    share = f"CAST(_n AS DECIMAL(19,0)) * CAST({test} AS DECIMAL(19,0))"
    n = f"CAST({max(1, tot)} AS DECIMAL(19,0))"
    c = counts.withColumn("_fr", F.expr(f"CAST(({share}) % {n} AS BIGINT)")).withColumn("_fl", F.expr(f"({share}) div {n}"))
    rem = test - int(c.agg(F.sum("_fl")).first()[0] or 0)
    c = positions(c, [F.col("_fr").desc(), *[F.col(s) for s in strata]], "_pos")
    return c.select(*strata, "_n", (F.col("_fl") + F.when(F.col("_pos") < rem, 1).otherwise(0)).alias("_k"))


def stratified_split(df: DataFrame, key: str | list, stratum: str, test_fraction: float, seed: int,
                     digits: int = DEFAULT_DIGITS, out: str = "split") -> DataFrame:
    """Exact stratified train/test split; adds ``split`` = train|test.

    Test rows are the smallest keyed hashes of each stratum; per-stratum
    sizes follow :func:`split_quotas`. All columns stay on one row, so
    features, label and any sensitive column are split alike (R2).
    """
    keys = _cols(key)
    r = df.withColumn("_rk", hash_rank(seed, "split", *keys))
    sel = select_k_smallest(r, "_rk", keys, [stratum], lambda n: split_quotas(n, [stratum], test_fraction),
                            digits, out="_t")
    return sel.withColumn(out, F.when(F.col("_t"), "test").otherwise("train")).drop("_t", "_rk")


def exact_k_quota(totals: DataFrame, percent: float) -> DataFrame:
    """``k = round_half_even(n * p / 100)`` per stratum of ``totals`` (``_n``)."""
    return totals.withColumn("_k", F.bround(F.col("_n") * F.lit(float(percent)) / 100, 0).cast("long"))


def sample_exact_k(df: DataFrame, key: str | list, percent: float, seed: int, salt: str = "pick",
                   digits: int = DEFAULT_DIGITS, out: str = "sampled") -> DataFrame:
    """Flag exactly ``k`` rows, drawn without replacement."""
    keys = _cols(key)
    r = df.withColumn("_rk", hash_rank(seed, salt, *keys))
    sel = select_k_smallest(r, "_rk", keys, [], lambda n: exact_k_quota(n, percent), digits, out=out)
    return sel.drop("_rk")


def uniform_in_range(lo: Column, hi: Column, seed: int, salt: str, *keys) -> Column:
    """Uniform value in [lo, hi) keyed by the row."""
    return lo + uniform(seed, salt, *keys) * (hi - lo)


def wrong_label(label: Column, classes: list, u: Column) -> Column:
    """Uniform over the other K-1 classes (any label type)."""
    arr = F.array(*[F.lit(c) for c in classes])
    others = F.filter(arr, lambda x: x != label)
    return F.element_at(others, (F.floor(u * (len(classes) - 1)) + 1).cast("int"))


def _ranges_and_classes(df: DataFrame, features: list, label: str):
    """A2 + A4 in one aggregate: clean min / max per feature and the sorted
    class list (``collect_set`` of a label column holds at most K values)."""
    aggs = [F.min(c).alias(f"min_{c}") for c in features] + [F.max(c).alias(f"max_{c}") for c in features]
    row = df.agg(*aggs, F.sort_array(F.collect_set(F.col(label))).alias("_classes")).first()
    return row, list(row["_classes"])


def _as_feature(new: Column, dtype: T.DataType) -> Column:
    """A drawn value as the feature's type; whole numbers are floored."""
    return (F.floor(new) if isinstance(dtype, T.IntegralType) else new).cast(dtype)


def poison(df: DataFrame, key: str, features: list, label: str, percent: float, seed: int,
           digits: int = DEFAULT_DIGITS, flag: str = "is_poisoned") -> DataFrame:
    """Poison ``percent`` % of the rows.

    Picks ``round_half_even(n * p / 100)`` rows (R3), replaces every feature by
    a uniform value within the clean column range (A2, R4) and the label by a
    random other class (A3, R5), and flags them. 0 % only adds the flag.
    Ranges and the class list are O(features + classes) aggregates.
    """
    if percent == 0:
        return df.withColumn(flag, F.lit(0))
    stats, classes = _ranges_and_classes(df, features, label)
    if len(classes) < 2:
        raise ValueError(f"{label!r} needs at least two classes to flip, found {classes}")
    s = sample_exact_k(df, key, percent, seed, "pick", digits, out="_p")
    repl = {}
    for c in features:
        new = uniform_in_range(F.lit(stats[f"min_{c}"]), F.lit(stats[f"max_{c}"]), seed, f"feat:{c}", key)
        repl[c] = F.when(F.col("_p"), _as_feature(new, df.schema[c].dataType)).otherwise(F.col(c))
    repl[label] = F.when(F.col("_p"), wrong_label(F.col(label), classes, uniform(seed, "label", key))).otherwise(F.col(label))
    repl[flag] = F.col("_p").cast("int")
    return s.withColumns(repl).drop("_p")


def array_ranges(df: DataFrame, col: str) -> tuple[list, list]:
    """A2 for an array column: per-position min and max in one vector
    aggregate (O(dims) values to the driver)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    row = (df.select(array_to_vector(F.col(col).cast("array<double>")).alias("_v"))
           .select(Summarizer.metrics("min", "max").summary(F.col("_v")).alias("s")).first()["s"])
    return list(row["min"]), list(row["max"])


def poison_runs(df: DataFrame, key: str, features: list, label: str, runs: list,
                digits: int = DEFAULT_DIGITS, flag: str = "is_poisoned",
                array_feature: str | None = None) -> DataFrame:
    """R6 for many runs in one job: ``runs`` = [(run_id, level, seed)].

    Rows are repeated once per run (an explode of a literal array of runs -
    the output is the union of all poisoned copies anyway), each run is a
    stratum of the k-smallest selection with its own seed, and the clean
    ranges / class list are computed once. Integral features are floored.
    """
    stats, classes = _ranges_and_classes(df, features, label)
    run_arr = F.array(*[F.struct(F.lit(int(r)).alias("run_id"), F.lit(int(lv)).alias("poisoning_level"),
                                 F.lit(int(sd)).alias("seed")) for r, lv, sd in runs])
    x = df.withColumn("_run", F.explode(run_arr)).select("*", "_run.*").drop("_run")
    seed = F.col("seed")
    x = x.withColumn("_rk", hash_rank(seed, "pick", key))
    def quota(n):
        return n.withColumn("_k", F.bround(F.col("_n") * F.col("poisoning_level").cast("double") / 100, 0)
                            .cast("long"))

    s = select_k_smallest(x, "_rk", [key], ["run_id", "poisoning_level"], quota, digits, out="_p")
    repl = {}
    for c in features:
        new = uniform_in_range(F.lit(stats[f"min_{c}"]), F.lit(stats[f"max_{c}"]), seed, f"feat:{c}", key)
        repl[c] = F.when(F.col("_p"), _as_feature(new, df.schema[c].dataType)).otherwise(F.col(c))
    if array_feature:
        # one lambda over the array: element i uses salt "feat:<array>[i]"
        lo, hi = array_ranges(df, array_feature)
        lo_a, hi_a = F.array(*map(F.lit, lo)), F.array(*map(F.lit, hi))
        et = df.schema[array_feature].dataType.elementType

        def elem(x, i):
            u = uniform(seed, F.concat(F.lit(f"feat:{array_feature}["), i.cast("string"), F.lit("]")), key)
            new = F.element_at(lo_a, i + 1) + u * (F.element_at(hi_a, i + 1) - F.element_at(lo_a, i + 1))
            return F.when(F.col("_p"), new.cast(et)).otherwise(x)

        repl[array_feature] = F.transform(F.col(array_feature), elem)
    repl[label] = F.when(F.col("_p"), wrong_label(F.col(label), classes, uniform(seed, "label", key))).otherwise(F.col(label))
    repl[flag] = F.col("_p").cast("int")
    return s.withColumns(repl).drop("_p", "_rk")


def shuffle_order(df: DataFrame, key: str | list, seed: int, salt: str = "shuffle") -> DataFrame:
    """A reproducible shuffle = order by keyed hash (ties by key)."""
    keys = _cols(key)
    return df.orderBy(hash_rank(seed, salt, *keys), *keys)


def shuffle_positions(df: DataFrame, key: str | list, seed: int, salt: str = "shuffle",
                      digits: int = 4, out: str = "shuffle_pos") -> DataFrame:
    """R7 as data: 0-based position of each row in the keyed shuffle."""
    keys = _cols(key)
    r = df.withColumn("_rk", hash_rank(seed, salt, *keys))
    return _global_rank(r, "_rk", keys, digits, out).drop("_rk")


def _global_rank(df: DataFrame, rank_col: str, tiebreak: list, digits: int, out: str) -> DataFrame:
    """0-based dense position in hash order without a one-task window:
    bucket offsets (<= 16**digits rows, so the broadcast is bounded) plus the
    rank inside the bucket (about n / 16**digits rows per window partition)."""
    b = df.withColumn("_bk", hash_bucket(F.col(rank_col), digits))
    counts = b.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.sum("_n").over(
        Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
    w = Window.partitionBy("_bk").orderBy(F.col(rank_col), *[F.col(c) for c in tiebreak])
    return (b.join(F.broadcast(offs.select("_bk", "_off")), "_bk")
            .withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
            .drop("_bk", "_off"))


def balanced_groups(df: DataFrame, key: str | list, n_groups: int, seed: int,
                    digits: int = 4, out: str = "group") -> DataFrame:
    """Deal 0, 1, ..., G-1 over a keyed shuffle; sizes differ by <= 1."""
    keys = _cols(key)
    r = df.withColumn("_rk", hash_rank(seed, "group", *keys))
    g = _global_rank(r, "_rk", keys, digits, "_pos")
    return g.withColumn(out, (F.col("_pos") % n_groups).cast("int")).drop("_rk", "_pos")


def surrogate_key(df: DataFrame, order_cols: list, out: str = "row_id",
                  n_ranges: int | None = None) -> DataFrame:
    """Dense 0-based id in the order of ``order_cols``, by
    :func:`petalframe.operators.prefix.positions`: ranges over the whole sort
    key (balanced even when one value of the first column holds a third of all
    rows), numbered inside, plus the rows of earlier ranges. The order must be
    total (unique ``order_cols``) for the ids to be reproducible."""
    return positions(df, _cols(order_cols), out, n_ranges)
