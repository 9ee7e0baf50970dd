"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the tokens of its source up to and
including it, in a keyed shuffled order, divided by the source's target. A
second pass over a source (its documents once more, in the same order) follows
its first. Copies are queued globally by the virtual time at which their
middle word is served (so a source ends within half a document of its target)
and the queue is cut where the running total would pass the budget. All in
DataFrame operations; planning shuffles ids, sources and sizes, never texts.

No running total is taken over a whole source in one task: the shuffle keys
are cut into slots, totals of slots are summed first (in blocks of slots, so that
no window grows with the rows), and windows only run inside a slot; the global
order likewise, in lanes of virtual time. Only the table of sources (one row
each) is ranked in one task.

Defined cases: null or empty text has size 0 and is never taken; a null source
is a source of its own, ranked last; repeated rows (same id, source and text)
queue one after the other and are counted, not ranked, row by row: a row of
numbers tells how many of them the mix takes; if all sizes are 0 the targets are
0; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petalframe.llm.common import WORD, write_stage
from petalframe.operators.prefix import offsets, positions

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2
SEED = "mix-1"
#: Shuffled documents whose running total one window takes, on average.
SLOT_ROWS = 2_000


def shuffle_key(doc_id: Column, seed: str = SEED) -> Column:
    """A keyed 60-bit hash of the id: md5, so other engines can repeat it."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running_total(df: DataFrame, by: list[str], slot: Column, order: list[Column], value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the rows up to each row, per ``by``, in the
    order (slot, order). Slots must grow with the order."""
    df = df.withColumn("_slot", slot)
    totals = df.groupBy(*by, "_slot").agg(F.sum(value).alias("_sum"))
    before = offsets(totals, by, ["_sum"], "_slot").select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col("_slot").alias("_s"), F.col("before__sum").alias("_before"))
    w = Window.partitionBy(*by, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_run", F.sum(value).over(w))
    same = F.col("_slot") == F.col("_s")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return (df.join(before, same).withColumn(out, F.col("_run") + F.col("_before"))
            .drop("_slot", "_s", "_run", "_before", *[f"_{c}" for c in by]))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, n_docs, target, budget`` from one row per source.

    Weights repeat in the order of the sources (code points, null last). A
    target stops at ``most`` times its source's size; what is left over is
    shared again by weight. That ends where every open source has
    ``level * weight``, with the level at which the targets meet the budget:
    sources close in the order of size / weight.
    """
    utf8 = F.to_binary(F.coalesce("source", F.lit("")), F.lit("utf-8"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), utf8))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("_w", weight).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_close = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), utf8)
    every = Window.partitionBy()
    s = (s.withColumn("_closed", F.coalesce(F.sum("_cap").over(by_close.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("_open", F.sum("_w").over(by_close.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("_budget", F.lit(float(share)) * F.sum("source_size").over(every)))
    # the level if this source and all that close later are open; the first that leaves its source open holds,
    # and closing more sources than needed only lowers it
    level = (F.col("_budget") - F.col("_closed")) / F.col("_open")
    s = s.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    s = s.withColumn("_level", F.max("_level").over(every))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return s.select("source", "source_size", "n_docs", target.alias("target"), F.col("_budget").alias("budget"))


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """What the mix takes: one row per distinct document (``doc_id, source,
    size, text_hash``) with ``repeats`` (equal input rows), ``source_size``,
    ``target``, ``copies`` (times they are taken, all of them together, at most
    ``most`` each) and ``finish`` (virtual finish time of the last's first copy)."""
    units = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                         F.xxhash64(text_col).alias("text_hash"))
             .groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("repeats"))
             .withColumn("u", shuffle_key(F.col("doc_id"), seed)).withColumn("words", F.col("size") * F.col("repeats")))
    units, n = write_stage(units, "mix-sizes")
    per_source = targets(units.groupBy("source").agg(F.sum("words").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
                         weights, share, most)
    t = write_stage(per_source, "mix-targets")[0].withColumnRenamed("source", "_src")
    units = units.join(t, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    # slots: equal ranges of the shuffle key, as many as suit the source's documents
    slot = F.floor(F.col("u") / F.lit(float(1 << 60)) * F.ceil(F.col("n_docs") / F.lit(slot_rows)))
    tie = ["u", "doc_id", "size", "text_hash"]
    units, _ = write_stage(running_total(units, ["source"], slot, [F.col(c) for c in tie], "words", "cum"), "mix-cum")

    before = F.col("cum") - F.col("words") + F.col("copy") * F.col("source_size")

    def due(n):  # the n-th of equal rows is due when its middle word is served; at time 1 every source is at its target
        return (before + (n - 0.5) * F.col("size")) / F.col("target")

    queued = units.where("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    fit = F.floor((F.col("target") - before) / F.col("size") + 0.5)
    fit = F.when(F.col("repeats") == 1, (due(F.lit(1)) <= 1).cast("bigint")).otherwise(F.greatest(F.lit(0), F.least(F.col("repeats"), fit)))
    queued = queued.withColumn("rows", fit.cast("bigint")).where("rows > 0").withColumn("due", due(F.col("rows"))).withColumn(
        "words", F.col("rows") * F.col("size"))
    # the global order by due time, in lanes of equal width; only the lane where the budget ends is sorted
    lanes = float(max(1, -(-2 * n // slot_rows)))
    queued = queued.withColumn("lane", F.floor(F.col("due") * lanes))
    sums = queued.groupBy("lane").agg(F.sum("words").alias("lane_words"), F.max("budget").alias("budget"))
    sums = sums.join(offsets(sums, [], ["lane_words"], "lane").select("lane", F.col("before_lane_words").alias("before")), "lane")
    over = sums.where("before <= budget and before + lane_words > budget").select(F.col("lane").alias("_lane"), "before")
    in_lane = Window.partitionBy("lane").orderBy("due", *tie).rowsBetween(Window.unboundedPreceding, 0)
    cut = (queued.join(over, F.col("lane") == F.col("_lane")).withColumn("total", F.sum("words").over(in_lane) + F.col("before"))
           .where("total > budget").select("due", *tie, "total", "words", "budget").orderBy("due", *tie).first())
    taken = F.col("rows")
    if cut is not None:
        # of the rows where the budget ends, as many as it still pays for
        last = int((cut["budget"] - (cut["total"] - cut["words"])) // cut["size"])
        same, earlier = F.lit(True), F.lit(False)
        for c in reversed(["due", *tie]):
            v = F.lit(cut[c])
            earlier = F.coalesce(F.col(c) < v, F.lit(False)) | (F.col(c).eqNullSafe(v) & earlier)
            same = same & F.col(c).eqNullSafe(v)
        taken = F.when(earlier, F.col("rows")).when(same, F.lit(last)).otherwise(F.lit(0))
    key = ["doc_id", "source", "size", "text_hash"]
    taken = queued.withColumn("taken", taken).where("taken > 0").groupBy(*key).agg(F.sum("taken").cast("bigint").alias("copies"))
    taken = taken.withColumnsRenamed({c: f"_t_{c}" for c in key})
    met = F.lit(True)
    for c in key:
        met = met & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return units.join(taken, met, "left").select(*key, "repeats", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"),
                                                 F.when(F.col("target") > 0, F.col("cum") / F.col("target")).alias("finish"))


def per_row(copies: Column, repeats: Column, nth: Column) -> Column:
    """Times the ``nth`` (from 0) of equal rows is taken: the copies dealt out evenly, the first rows one more."""
    even = F.floor(copies / repeats)
    return (even + (nth < copies - even * repeats).cast("bigint")).cast("bigint")


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED,
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents, all input columns: a document taken twice is two rows."""
    plan = plan_mix(docs, weights, share, most, seed, id_col, text_col, source_col).where("copies > 0")
    names = ("doc_id", "source", "size", "text_hash", "copies", "repeats")
    p, _ = write_stage(plan.select(*[F.col(c).alias(f"_mix_{c}") for c in names]), "mix-plan")
    same = (F.col(id_col).eqNullSafe(F.col("_mix_doc_id")) & F.col(source_col).eqNullSafe(F.col("_mix_source"))
            & (F.xxhash64(text_col) == F.col("_mix_text_hash")) & (word_count(F.col(text_col)) == F.col("_mix_size")))
    even = docs.join(p.where("_mix_copies % _mix_repeats = 0"), same).withColumn("_mix_n", F.expr("_mix_copies div _mix_repeats"))
    # equal rows of which some are taken once more: numbered over ranges, not in one task
    odd = p.where("_mix_copies % _mix_repeats > 0")
    unit = ["_mix_doc_id", "_mix_source", "_mix_text_hash"]
    rows = positions(docs.join(odd, same).withColumn("_mix_spread", F.monotonically_increasing_id()), [*unit, "_mix_spread"], "_mix_at")
    first = rows.groupBy(*unit).agg(F.min("_mix_at").alias("_mix_first")).withColumnsRenamed({c: f"{c}_f" for c in unit})
    met = F.lit(True)
    for c in unit:
        met = met & F.col(c).eqNullSafe(F.col(f"{c}_f"))
    n = per_row(F.col("_mix_copies"), F.col("_mix_repeats"), F.col("_mix_at") - F.col("_mix_first"))
    rows = rows.join(first, met).withColumn("_mix_n", n).where("_mix_n > 0")
    cols = [*docs.columns, "_mix_n"]
    out = even.select(*cols).unionByName(rows.select(*cols))
    return out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_n").cast("int")))).select(*docs.columns)
