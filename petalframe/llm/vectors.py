"""Vectors for the search operators: cleaning, packed blocks, best-of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str, zero: bool = True) -> DataFrame:
    """``(vec_id, v array<double>)`` without null ids, null vectors, and vectors
    with null or non-finite components (or, if not ``zero``, zero vectors)."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def matrix(batch: pa.RecordBatch, column: str = "v") -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrices of a batch's vectors, by their length."""
    col = batch.column(column)
    sizes = np.diff(col.offsets.to_numpy())
    flat, starts = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()[:-1]
    out = []
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        out.append((at, flat[starts[at][:, None] + np.arange(d)[None, :]]))
    return out


def unpack(ids: bytes, data: bytes, d: int, dtype=np.float64) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(data, dtype).reshape(len(i), d)


def best_rows(found: DataFrame, k: int, smallest: bool) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best; ties to the smaller id."""
    order = [F.col("score") if smallest else F.desc("score"), F.col("vec_id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The k best (score, id) of each query met so far, in one task: of each
    id its best score only, however often the id is repeated."""

    def __init__(self, k: int, smallest: bool):
        self.k, self.sign, self.of = k, 1 if smallest else -1, {}

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(ids):
            return
        old = self.of.get(query)
        if old is not None:
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        key = self.sign * scores
        if len(key) > 4 * self.k:
            near = key <= np.partition(key, 4 * self.k - 1)[4 * self.k - 1]
            # rows beyond that are passed over only if those before hold k different ids
            if len(np.unique(ids[near])) >= self.k:
                scores, ids, key = scores[near], ids[near], key[near]
        order = np.lexsort((key, ids))
        order = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
        order = order[np.lexsort((ids[order], key[order]))]
        self.of[query] = (scores[order[:self.k]], ids[order[:self.k]])

    def rows(self, score_type: pa.DataType) -> pa.RecordBatch:
        q = np.repeat(np.fromiter(self.of, np.int64, len(self.of)), [len(v[1]) for v in self.of.values()])
        scores = np.concatenate([v[0] for v in self.of.values()]) if self.of else []
        ids = np.concatenate([v[1] for v in self.of.values()]) if self.of else []
        self.of = {}
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids, pa.int64()), pa.array(scores).cast(score_type)], ["query_id", "vec_id", "score"])
