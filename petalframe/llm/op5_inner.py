"""Exact top-k inner products over norm-sorted, rotated vectors.

Vectors are dealt by descending length into packed blocks, numbered in that
order. The longest block comes first: every query is scored against it in the
task that packs it, which gives the query a bar, its k-th score so far. By
Cauchy-Schwarz only vectors of length bar / |query| or more can still reach it;
queries are packed by that least length, so a query block needs a prefix of the
vector blocks, cut into stripes of blocks. Blocks and queries meet by stripe: a
vector is shuffled once, a query block once per stripe it needs, and nothing
that the length bound rules out is sent at all.

Inside a block, vectors are rotated by the singular vectors of all data, which
gathers the length in the first coordinates: the partial sum over a growing
prefix of them plus the product of the two residual lengths bounds the score,
and only vectors whose bound reaches the bar are evaluated, exactly, on the
original integers.

The rotation comes from the d x d sums of products over all vectors; it and
the longest block of each length d are all that the driver holds.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; a zero vector scores 0; vectors of
different lengths are not compared; equal scores go to the smaller id;
repeated ids are one candidate, at their best score; scores beyond 2**53 are
summed in whole numbers and must fit a bigint; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import write_stage
from petalframe.llm.vectors import Best, best_rows, matrix, unpack, usable
from petalframe.operators.prefix import positions

VECTOR_BLOCK, QUERY_BLOCK, STRIPE = 4096, 512, 8
#: Shares of the coordinates over which partial sums are taken, one after the other.
PREFIXES = (0.125, 0.25, 0.5)
#: Queries whose best a task holds before it hands them on.
HELD = 50_000


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the right singular vectors of all rows."""

    def run(batches):
        for b in batches:
            for _, x in matrix(b):
                g = (x.T @ x).ravel()
                d = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), d)), pa.array(np.arange(len(g))), pa.array(g)], ["d", "i", "g"])

    sums = rows.mapInArrow(run, "d bigint, i bigint, g double").groupBy("d", "i").agg(F.sum("g").alias("g")).collect()
    out = {}
    for d in {r["d"] for r in sums if r["d"]}:
        g = np.zeros(d * d)
        for r in sums:
            if r["d"] == d:
                g[r["i"]] = r["g"]
        out[d] = np.linalg.eigh(g.reshape(d, d))[1][:, ::-1]
    return out


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``(d, longest, ids, data)`` from rows that lie in the order wanted."""

    def run(batches):
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            for at, x in matrix(b):
                for s in range(0, len(at), size):
                    part = x[s:s + size]
                    longest = float(np.sqrt((part ** 2).sum(axis=1)).max())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.shape[1]], pa.int32()), pa.array([longest]), pa.array([ids[at[s:s + size]].tobytes()], pa.binary()),
                         pa.array([part.tobytes()], pa.binary())], ["d", "longest", "ids", "data"])

    return rows.mapInArrow(run, "d int, longest double, ids binary, data binary")


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whole-number inner products of one vector with rows."""
    if len(y) and np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, len(x)) < 2.0 ** 53:
        return (y @ x).astype(np.int64)
    whole = [int(a) for a in x]
    return np.array([sum(a * int(b) for a, b in zip(whole, row)) for row in y], dtype=np.int64)


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest inner products of ``floor(scale * x)`` vectors per
    query row (``is_query`` over ``vec_id``): ``query_id, rank, vec_id, score``."""
    rows = usable(vectors, id_col, vector_col).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    rows = rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows, n = write_stage(rows, "ip-vectors")
    spin = rotations(rows)
    parts = max(1, -(-n // VECTOR_BLOCK))
    by_length = rows.repartitionByRange(parts, F.desc("norm2"), F.col("vec_id")).sortWithinPartitions(F.desc("norm2"), "vec_id")
    blocks, _ = write_stage(_blocks(by_length, VECTOR_BLOCK).withColumn("at", F.monotonically_increasing_id()), "ip-blocks")
    blocks = positions(blocks, ["d", F.desc("longest"), "at"], "place")
    first = blocks.groupBy("d").agg(F.min("place").alias("_first"))
    blocks = blocks.join(F.broadcast(first), "d").withColumn("stripe", F.floor((F.col("place") - F.col("_first")) / STRIPE))
    longest = {r["d"]: unpack(r["ids"], r["data"], r["d"]) for r in blocks.where("place = _first").select("d", "ids", "data").collect()}

    def lower_bars(batches):
        """Every query with its best among the longest vectors, and the length others need to reach them."""
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            for at, x in matrix(b):
                v, y = longest[x.shape[1]]
                bars, need = np.full(len(at), -np.inf), np.zeros(len(at))
                for j in range(len(at)):
                    best, other = Best(k, False), v != ids[at[j]]
                    best.add(0, _exact(x[j], y[other]), v[other])
                    scores = best.of[0][0] if best.of else ()
                    if len(scores) == k:
                        bars[j] = float(scores[-1])
                        if bars[j] > 0:  # then the query has a length
                            need[j] = bars[j] / np.sqrt((x[j] ** 2).sum()) * (1 - 1e-9)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(bars), pa.array(need),
                     pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "d", "bar", "need", "v"])

    def packed(batches):
        """Sorted queries in blocks of one length d, with the least length any of them needs."""
        for b in batches:
            d = b.column("d").to_numpy()
            for size in np.unique(d):
                at = np.flatnonzero(d == size)
                for s in range(0, len(at), QUERY_BLOCK):
                    part = at[s:s + QUERY_BLOCK]
                    data = b.column("v").take(pa.array(part)).to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size], pa.int32()), pa.array([b.column("need").to_numpy()[part].min()]),
                         pa.array([b.column("vec_id").to_numpy()[part].tobytes()], pa.binary()),
                         pa.array([b.column("bar").to_numpy()[part].tobytes()], pa.binary()), pa.array([b"".join(data)], pa.binary())],
                        ["d", "need", "qids", "bars", "qdata"])

    asked = rows.where(is_query).mapInArrow(lower_bars, "vec_id bigint, d int, bar double, need double, v binary")
    asked, n_asked = write_stage(asked, "ip-bars")
    query_parts = max(1, -(-n_asked // (4 * QUERY_BLOCK)))
    asked = asked.repartitionByRange(query_parts, "d", "need", "vec_id").sortWithinPartitions("d", "need", "vec_id")
    asked, _ = write_stage(asked.mapInArrow(packed, "d int, need double, qids binary, bars binary, qdata binary"), "ip-queries")
    # how many stripes hold vectors of at least some length: the stripes' longest, one short row each
    edges = blocks.groupBy("d", "stripe").agg(F.max("longest").alias("longest")).groupBy("d").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("longest")).alias("l"), "stripe"))).alias("edges"))
    wanted = F.filter("edges", lambda e: -e["l"] >= F.col("need"))
    asked = asked.join(edges, "d").select("d", "qids", "bars", "qdata", F.explode(F.transform(wanted, lambda e: e["stripe"])).alias("stripe"))
    pairs = blocks.select("d", "stripe", "longest", "ids", "data").join(asked, ["d", "stripe"])

    def search(batches):
        best = Best(k, False)
        for b in batches:
            for d, longest_, vi, vd, qi, qb, qd in zip(*(c.to_pylist() for c in b.columns)):
                (q, x), (v, y) = unpack(qi, qd, d), unpack(vi, vd, d)
                least = np.frombuffer(qb, np.float64)
                turn = spin.get(d)
                xr, yr = (x @ turn, y @ turn) if d else (x, y)
                x_len = np.sqrt((x ** 2).sum(axis=1))
                cuts = sorted({max(1, int(d * f)) for f in PREFIXES}) if d > 1 else []
                y_rest = {c: np.sqrt((yr[:, c:] ** 2).sum(axis=1)) for c in cuts}
                for j in range(len(q)):
                    at = np.flatnonzero(v != q[j])
                    old = best.of.get(int(q[j]))
                    bar = max(least[j], float(old[0][-1]) if old is not None and len(old[0]) == k else -np.inf)
                    if bar > -np.inf:
                        slack = 1e-9 * (1 + x_len[j] * longest_)
                        if x_len[j] * longest_ + slack < bar:
                            continue
                        total, done = np.zeros(len(at)), 0
                        for c in cuts:  # a longer prefix for those that a shorter one leaves
                            total += yr[at, done:c] @ xr[j, done:c]
                            stays = total + np.sqrt((xr[j, c:] ** 2).sum()) * y_rest[c][at] + slack >= bar
                            at, total, done = at[stays], total[stays], c
                    best.add(int(q[j]), _exact(x[j], y[at]), v[at])
            if len(best.of) > HELD:
                yield best.rows(pa.int64())
        yield best.rows(pa.int64())

    found = (pairs.select("d", "longest", "ids", "data", "qids", "bars", "qdata")
             .mapInArrow(search, "query_id bigint, vec_id bigint, score bigint"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best_rows(found, k, False).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
