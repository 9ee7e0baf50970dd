"""Hierarchical multi-length packing.

Every task packs the documents it reads, a pool of bounded size at a time, so
nothing is shuffled and neither a hot source nor a row repeated very often makes
a large group. A document's ids (with the end id) beyond its last full context
size are windows of their own at once; what is left waits in the pool. There
each piece is routed to the smallest context tier (a power of two) that holds
it. The longest piece opens a window of its tier; the gap takes the longest
piece of that or a shorter tier that still fits, again and again; a window that
cannot be filled moves to the next tier, and at the longest tier the gap is
filled by cutting the shortest piece that is longer than it. So only the last
window of a pool may end with a gap. Windows are dealt to step groups in order
of their attention cost, back and forth, so steps of one tier cost about the same.

Pieces left of each length are bits of one integer: the longest that fits and
the shortest that is longer are single operations. A pool holds ``POOL_IDS`` ids
and one document's remainder at most.

Defined cases: a null or empty text is the end id alone; an empty table gives
an empty result; repeated rows are separate documents; a null ``doc_id`` is
carried as null; other columns are ignored.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from petalframe.llm.common import id_and_text, released
from petalframe.llm.tokens import tokenizer
from petalframe.llm.words import small_batches

END_ID = 0
TIERS = (128, 256, 512, 1024)
#: Characters that are tokenised at a time.
ENCODED_CHARS = 1 << 18
#: Ids of a pool, about; sequences in a step group.
POOL_IDS, STEP = 1_000_000, 64
_ROW = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, tier bigint, sequence_size bigint, step_group bigint")


def encode_documents(batches, vocabulary: str | None, end_id: int = END_ID) -> Iterator[tuple[object, np.ndarray]]:
    """``(doc_id, ids with the end id)`` for record batches of doc_id and text."""
    tok = tokenizer(vocabulary)
    for b in released(batches):
        docs, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
        for i, k in small_batches(texts, ENCODED_CHARS):
            ids, at = tok.encode(texts[i:k])
            for j in range(k - i):
                yield docs[i + j], np.append(ids[at[j]:at[j + 1]], np.uint32(end_id))


def pack_lengths(lengths: np.ndarray, tiers: tuple[int, ...] = TIERS) -> tuple[np.ndarray, np.ndarray]:
    """Pack pieces of 1 to ``tiers[-1]`` ids into windows, cutting where a gap
    needs it. Returns the parts, one row each ``(piece, first id in it, ids,
    window, offset)``, and the size of each window."""
    size = tiers[-1]
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by length: (piece, first id)
    have = 0  # bit x: a piece of length x waits
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        waiting[lengths[i]].append((i, 0))
    for x in np.unique(lengths).tolist():
        have |= 1 << x
    parts: list[tuple[int, int, int, int, int]] = []
    sizes: list[int] = []

    def take(x: int) -> tuple[int, int]:
        nonlocal have
        piece = waiting[x].pop()
        if not waiting[x]:
            have ^= 1 << x
        return piece

    while have:
        x, used = have.bit_length() - 1, 0
        tier = next(k for k, t in enumerate(tiers) if t >= x)
        while True:
            if x:
                piece, first = take(x)
                parts.append((piece, first, x, len(sizes), used))
                used += x
                if used == tiers[tier]:
                    break
            elif tiers[tier] < size:
                tier += 1
            else:  # nothing fits: the shortest of the longer pieces gives what the gap needs
                gap = size - used
                longer = have >> (gap + 1)
                if longer:
                    y = gap + (longer & -longer).bit_length()
                    piece, first = take(y)
                    parts.append((piece, first, gap, len(sizes), used))
                    if not waiting[y - gap]:
                        have |= 1 << (y - gap)
                    waiting[y - gap].append((piece, first + gap))
                break
            x = max(0, (have & ((2 << (tiers[tier] - used)) - 1)).bit_length() - 1)
        sizes.append(tiers[tier])
    return np.array(parts, dtype=np.int64).reshape(-1, 5), np.array(sizes, dtype=np.int64)


def _steps(cost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Step group of each window: those of one size, dearest first, dealt back and forth."""
    step = np.empty(len(sizes), dtype=np.int64)
    for n in np.unique(sizes):
        mine = np.flatnonzero(sizes == n)
        mine = mine[np.argsort(-cost[mine], kind="stable")]
        groups = -(-len(mine) // STEP)
        turn = np.arange(len(mine)) % (2 * groups)
        step[mine] = np.minimum(turn, 2 * groups - 1 - turn)
    return step


def pack_documents(docs: DataFrame, tiers: tuple[int, ...] = TIERS, vocabulary: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text", pool_ids: int = POOL_IDS) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece:
    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier,
    sequence_size, step_group``. A sequence is padded to ``sequence_size``:
    its content if that is one of the tiers, else the longest tier."""
    size = tiers[-1]

    def crc(ids: np.ndarray) -> int:
        return zlib.crc32(ids.astype("<u4", copy=False).tobytes())

    def rows_of(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in _ROW.split(", ")])

    def run(batches):
        sequence, pool, held = TaskContext.get().partitionId() << 32, [], 0
        full: list[tuple] = []

        def packed():
            nonlocal sequence, held
            lengths = np.array([len(ids) for _, ids, _, _ in pool], dtype=np.int64)
            parts, sizes = pack_lengths(lengths, tiers)
            piece, first, n, window, offset = parts.T
            cost = np.bincount(window, weights=n.astype(float) ** 2, minlength=len(sizes))
            at = [pool[p] for p in piece.tolist()]
            yield rows_of([
                [p[0] for p in at], [p[2] + f for p, f in zip(at, first.tolist())], n,
                [crc(p[1][f:f + k]) for p, f, k in zip(at, first.tolist(), n.tolist())], [p[3] for p in at],
                sequence + window, offset, np.array(tiers)[np.searchsorted(tiers, n)], sizes[window], sequence + _steps(cost, sizes)[window]])
            sequence += len(sizes)
            pool.clear()
            held = 0

        for doc, ids in encode_documents(batches, vocabulary):
            for s in range(0, len(ids) - size + 1, size):
                full.append((doc, s, size, crc(ids[s:s + size]), len(ids), sequence, 0, size, size, sequence // STEP * STEP))
                sequence += 1
            rest = len(ids) % size
            if rest:
                pool.append((doc, ids[len(ids) - rest:].copy(), len(ids) - rest, len(ids)))
                held += rest
            if len(full) >= 20_000:
                yield rows_of(zip(*full))
                full = []
            if held >= pool_ids:
                yield from packed()
        if full:
            yield rows_of(zip(*full))
        if pool:
            yield from packed()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _ROW)
