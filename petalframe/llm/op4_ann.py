"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector by ``HASHES`` random projections, cut into cells of
``WIDTH`` standard deviations of the data. A query visits its own bucket and
then neighbouring ones, in the order of their estimated success: the sum of
the squared distances from its projections to the cell borders crossed.
Buckets of all tables give candidates, which are ranked by exact distance.

Every vector is indexed in every table. Vectors of a map batch that fall into
one bucket travel as one packed row, queries likewise, so a bucket that holds a
third of all vectors is many rows, which the join may split; a task keeps the
best of each query, not all candidates. Queries that found fewer than ``k``
candidates are searched exactly, in blocks against table 0.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors of different
lengths are not compared; equal distances go to the smaller id; repeated ids
are one candidate, at their nearest vector; an empty table gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import write_stage
from petalframe.llm.vectors import Best, best_rows, matrix, unpack, usable
from petalframe.llm.words import mix

TABLES, HASHES, WIDTH, PROBES = 6, 6, 2.0, 64
SEED = 20240601


class Hashing:
    def __init__(self, scale: float, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES, seed: int = SEED):
        self.scale, self.tables, self.hashes, self.width, self.probes, self.seed = scale, tables, hashes, width, probes, seed
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=hashes)), dtype=np.int64)
        self.steps = steps[np.argsort(np.abs(steps).sum(axis=1), kind="stable")]

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers, and the position inside the cell in [0, 1)."""
        rng = np.random.default_rng([self.seed, table, x.shape[1]])
        a, b = rng.normal(size=(x.shape[1], self.hashes)), rng.uniform(size=self.hashes)
        at = x @ a / (self.width * self.scale) + b
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def bucket(self, cells: np.ndarray, d: int) -> np.ndarray:
        h = np.full(cells.shape[:-1], d, dtype=np.uint64)
        for j in range(self.hashes):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[..., j].astype(np.uint64))
        return h.view(np.int64)

    def visits(self, x: np.ndarray, table: int) -> np.ndarray:
        """Buckets to visit, the likeliest first: one row per query."""
        cell, at = self.cells(x, table)
        # crossing the lower border costs the squared position, the upper one the squared rest
        cost = np.stack([at ** 2, np.zeros_like(at), (1 - at) ** 2])
        total = sum(cost[self.steps[:, j] + 1, :, j] for j in range(self.hashes)).T
        n = min(self.probes, len(self.steps))
        first = np.argsort(total, axis=1, kind="stable")[:, :n]
        return self.bucket(cell[:, None, :] + self.steps[first], x.shape[1])


def _packed(rows: DataFrame, hashing: Hashing, queries: bool) -> DataFrame:
    """``(tab, bucket, d, ids, data)``: the vectors of a map batch in one bucket."""

    def run(batches):
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            for at, x in matrix(b):
                for t in range(hashing.tables):
                    if queries:
                        h = hashing.visits(x, t)
                        who = np.repeat(np.arange(len(at)), h.shape[1])
                        h = h.ravel()
                    else:
                        h, who = hashing.bucket(hashing.cells(x, t)[0], x.shape[1]), np.arange(len(at))
                    order = np.argsort(h, kind="stable")
                    h, who = h[order], who[order]
                    cuts = np.r_[np.flatnonzero(np.r_[True, h[1:] != h[:-1]]), len(h)]
                    cols = [[], [], []]
                    for s, e in zip(cuts[:-1], cuts[1:]):
                        w = who[s:e]
                        cols[0].append(int(h[s]))
                        cols[1].append(ids[at[w]].tobytes())
                        cols[2].append(x[w].tobytes())
                    n = len(cols[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t] * n, pa.int32()), pa.array(cols[0], pa.int64()), pa.array([x.shape[1]] * n, pa.int32()),
                         pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], ["tab", "bucket", "d", "ids", "data"])

    return rows.mapInArrow(run, "tab int, bucket bigint, d int, ids binary, data binary")


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """Best candidates of packed queries against packed vectors, per task."""

    def run(batches):
        best = Best(k, True)
        for b in batches:
            for d, qi, qd, vi, vd in zip(*(b.column(c).to_pylist() for c in ("d", "qids", "qdata", "ids", "data"))):
                (q, x), (v, y) = unpack(qi, qd, d), unpack(vi, vd, d)
                # squared distances by one product, to pass over what cannot enter a query's best
                x2, y2 = (x ** 2).sum(axis=1), (y ** 2).sum(axis=1)
                square = x2[:, None] + y2[None, :] - 2 * (x @ y.T)
                bars = np.array([best.of[i][0][-1] if i in best.of and len(best.of[i][0]) == k else np.inf for i in q.tolist()])
                slack = 1e-9 * (x2 + y2.max(initial=0.0)) + 1e-12
                near = (square <= (bars ** 2 + slack)[:, None]) & (v[None, :] != q[:, None])
                for j in np.flatnonzero(near.any(axis=1)).tolist():
                    at = np.flatnonzero(near[j])
                    best.add(int(q[j]), np.sqrt(((y[at] - x[j]) ** 2).sum(axis=1)), v[at])
            if len(best.of) > 50_000:
                yield best.rows(pa.float64())
        yield best.rows(pa.float64())

    return pairs.select("d", "qids", "qdata", "ids", "data").mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                       hashing: Hashing | None = None) -> DataFrame:
    """The ``k`` nearest found per query row (``is_query`` over ``vec_id``):
    ``query_id, rank, vec_id, score`` (Euclidean distance)."""
    rows = usable(vectors, id_col, vector_col, zero=False)
    if hashing is None:
        # spread of the data: mean squared distance from the mean vector
        per = (rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("var")).agg(F.sum("var").alias("s")).first()["s"])
        hashing = Hashing(float(per) ** 0.5 if per else 1.0)
    queries = rows.where(is_query)
    index, _ = write_stage(_packed(rows, hashing, False), "ann-index")
    asked = _packed(queries, hashing, True).withColumnsRenamed({"ids": "qids", "data": "qdata"})
    found = _nearest(index.join(asked, ["tab", "bucket", "d"]), k)
    found = best_rows(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), k, True)
    found, _ = write_stage(found, "ann-found")
    short = queries.join(found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k), "vec_id", "left_anti")
    one = Hashing(1.0, tables=1, hashes=1, width=1e300, probes=1)  # a single bucket: queries packed by batch
    few, n_few = write_stage(_packed(short, one, True).select("d", F.col("ids").alias("qids"), F.col("data").alias("qdata")), "ann-short")
    if n_few:
        exact = _nearest(index.where("tab = 0").join(few, "d"), k)
        exact = best_rows(exact.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), k, True)
        found = found.join(exact.select("query_id").distinct(), "query_id", "left_anti").unionByName(exact)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
