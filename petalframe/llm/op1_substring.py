"""Substring dedup with difference-cover anchors.

A repeated passage is a run of ``window`` words that also starts in a document
with a smaller id. Instead of one hash per position, hashes of shorter runs
(anchors) are taken only at positions whose remainder modulo a period lies in
a difference cover: for any two positions some shift below the period brings
both remainders into the cover, so two equal windows always hold an equal
anchor at a covered position of both. The steps:

1. anchors of every document; those seen in two documents come back to them;
2. windows around the shared anchors only are hashed (the extension); every
   document but the smallest that holds a window gets that window back;
3. words covered by the windows that came back are removed.

Rows are pre-aggregated inside each map batch before both shuffles: a hash
that many documents of a batch hold travels as one row a batch, so a passage
in a third of all documents does not gather in one task. The reduce side
reads sorted rows as a stream and keeps one row of state. Texts travel
compressed. Hashes have 64 bits; a false removal needs two different windows
with equal hashes, both around shared anchors.

Defined cases: a null or empty text has no words; a text with fewer words
than the window loses nothing; repeated rows with one ``doc_id`` are the same
document (no "smaller id" among them) and each row is answered; a null
``doc_id`` neither removes nor loses words; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import compressed, decompress, id_and_text
from petalframe.llm.words import Words, grams, signed, small_batches

#: Perfect difference sets, period to residues.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    21: (3, 6, 7, 12, 14),
    31: (1, 5, 11, 24, 25, 27),
}
#: Rows that one map batch pre-aggregates at a time.
CHUNK = 1 << 20


def cover_for(window: int) -> tuple[int, np.ndarray, int]:
    """``(period, residues, anchor words)``: the largest period that leaves an
    anchor of more than a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * (window - p + 1) > window)
    return period, np.array(COVERS[period]), window - period + 1


def anchor_positions(n_words: int, window: int) -> np.ndarray:
    period, residues, size = cover_for(window)
    at = (np.arange(0, n_words + period, period)[:, None] + residues[None, :]).ravel()
    return at[at <= n_words - size]


def _gather(found, whole_groups: bool):
    """Pre-aggregate (hash, doc) pairs: arrays (h, doc, closed). A row that is
    not closed still waits for other batches; closed rows are decided."""
    h = np.concatenate([x[0] for x in found])
    d = np.concatenate([x[1] for x in found])
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.empty(0, bool)
    h, d = h[new], d[new]
    first = np.r_[True, h[1:] != h[:-1]] if len(h) else np.empty(0, bool)
    shared = ~first
    if whole_groups and len(h):
        several = np.r_[~first[1:], False]
        shared = shared | (first & several)
    return (np.concatenate([h[first], h[shared]]), np.concatenate([d[first], d[shared]]),
            np.concatenate([np.zeros(first.sum(), bool), np.ones(shared.sum(), bool)]))


def _batch(h, d, closed=None):
    cols, names = [pa.array(signed(h)), pa.array(d)], ["h", "doc_id"]
    if closed is not None:
        cols, names = [*cols, pa.array(closed)], [*names, "closed"]
    return pa.RecordBatch.from_arrays(cols, names)


def _emit(pairs, whole_groups: bool):
    """Record batches of pre-aggregated rows from an iterator of (hashes, doc)."""
    held, n = [], 0
    for h, doc in pairs:
        if len(h):
            held.append((h, np.full(len(h), doc, dtype=np.int64)))
            n += len(h)
        if n >= CHUNK:
            yield _batch(*_gather(held, whole_groups))
            held, n = [], 0
    if held:
        yield _batch(*_gather(held, whole_groups))


def _shared(rows: DataFrame, whole_groups: bool) -> DataFrame:
    """``(h, doc_id)`` of hashes held by two documents: of all documents, or
    (not ``whole_groups``) of all but the smallest."""

    def reduce(batches):
        last_h = last_d = None
        told = False  # whether the first document of the open group went out
        for b in batches:
            h, d = b.column("h").to_numpy(), b.column("doc_id").to_numpy()
            closed = b.column("closed").to_numpy(zero_copy_only=False)
            out_h, out_d = [h[closed]], [d[closed]]
            h, d = h[~closed], d[~closed]
            if len(h):
                first = np.r_[last_h is None or h[0] != last_h, h[1:] != h[:-1]]
                group = np.cumsum(first) - (1 if first[0] else 0)
                heads = d[first] if first[0] else np.r_[last_d, d[first]]
                head = heads[group]
                later = d != head
                out_h.append(h[later])
                out_d.append(d[later])
                if whole_groups:
                    g = np.unique(group[later])
                    if len(g) and g[0] == 0 and not first[0] and told:
                        g = g[1:]
                    hashes = h[first] if first[0] else np.r_[last_h, h[first]]
                    out_h.append(hashes[g])
                    out_d.append(heads[g])
                    told = bool(later[group == group[-1]].any()) or (told and group[-1] == 0 and not first[0])
                last_h, last_d = h[-1], head[-1]
            yield _batch(np.concatenate(out_h), np.concatenate(out_d))

    key = F.when(F.col("closed"), F.xxhash64("doc_id", "h")).otherwise(F.col("h"))
    return rows.repartition(key).sortWithinPartitions("closed", "h", "doc_id").mapInArrow(reduce, "h bigint, doc_id bigint")


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    size = cover_for(window)[2]

    def per_doc(batches):
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for i, k in small_batches(texts):
                words = Words(texts[i:k])
                for j in range(k - i):
                    h = words.of(j)
                    if len(h) >= window:
                        yield np.unique(grams(h, size, anchor_positions(len(h), window))), ids[i + j]

    return docs.mapInArrow(lambda batches: _emit(per_doc(batches), True), "h bigint, doc_id bigint, closed boolean")


def _windows(docs: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows that hold a shared anchor."""
    size = cover_for(window)[2]

    def per_doc(batches):
        for b in batches:
            ids, zs, hs = b.column("doc_id").to_pylist(), b.column("z").to_pylist(), b.column("hs")
            for r, (doc, z) in enumerate(zip(ids, zs)):
                h = Words([decompress(z)]).of(0)
                if len(h) < window:
                    continue
                at = anchor_positions(len(h), window)
                near = at[np.isin(signed(grams(h, size, at)), hs[r].values.to_numpy())]
                n = len(h) - window + 1
                # a window from s holds the anchor at p if p - (window - size) <= s <= p
                step = np.zeros(n + 1, dtype=np.int64)
                np.add.at(step, np.clip(near - (window - size), 0, n), 1)
                np.add.at(step, np.clip(near + 1, 0, n), -1)
                yield np.unique(grams(h, window, np.flatnonzero(np.cumsum(step[:n]) > 0))), doc

    lists = shared.groupBy("doc_id").agg(F.collect_list("h").alias("hs"))
    return compressed(docs).join(lists, "doc_id").mapInArrow(
        lambda batches: _emit(per_doc(batches), False), "h bigint, doc_id bigint, closed boolean")


def dedup_substrings(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove words covered by a ``window``-word passage that also starts in a
    document with a smaller id.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_text`` (the kept words joined by one space).
    """
    if window < 1:
        raise ValueError("window must be at least 1 word")
    docs = id_and_text(docs, id_col, text_col)
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    repeated = _shared(_windows(known, _shared(_anchors(known, window), True), window), False)
    lists = repeated.groupBy("doc_id").agg(F.collect_list("h").alias("hs"))

    def remove(batches):
        for b in batches:
            out = []
            hs = b.column("hs")
            for r, (doc, z) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("z").to_pylist())):
                text = decompress(z) or ""
                if hs[r].is_valid:
                    words = Words([text])
                    h = words.of(0)
                    gone = np.zeros(len(h) + 1, dtype=np.int64)
                    if len(h) >= window:
                        s = np.flatnonzero(np.isin(signed(grams(h, window)), hs[r].values.to_numpy()))
                        gone[s] += 1
                        gone[s + window] -= 1
                    gone = np.cumsum(gone[:len(h)]) > 0
                    out.append((doc, len(h), int(gone.sum()), words.kept_bytes(0, ~gone)))
                else:
                    words = text.encode("utf-8", "surrogatepass").split()
                    out.append((doc, len(words), 0, b" ".join(words)))
            ids, n, m, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return compressed(docs).join(lists, "doc_id", "left").mapInArrow(
        remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
