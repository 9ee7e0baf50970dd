"""Best-two-fit packing of whole documents into sequences of one size.

A document's ids (with the end id) that are more than a sequence holds are cut
into full pieces, the first one holding the rest; full pieces are sequences of
their own and never move. All shorter pieces are dealt to groups of bounded
size by the task and row number they were written with. Inside a group one
sequence after the other is filled greedily (the longest piece that fits,
again and again); if a gap stays, the smallest piece in it is taken out again
for the two unpacked pieces whose sum fits the widened gap most tightly, if
that leaves less of it. Lengths left are bits of one integer, so the longest
piece up to a gap and the two pieces of a given sum are single operations.

Ids are made in one pass, which also takes each piece's checksum; one short
row a piece is shuffled, never the ids.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` is
carried as null; repeated rows are separate documents; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import id_and_text, write_stage
from petalframe.llm.tokens import tokenizer
from petalframe.llm.words import small_batches

END_ID, SIZE = 0, 2048
#: Pieces in a packing group, on average.
GROUP_PIECES = 100_000

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_documents(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``(doc_id, text)``: ``doc_id, piece, start, length, ids_crc32``."""
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        tok = tokenizer(vocabulary)
        for b in batches:
            ids_of, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for i, k in small_batches(texts, 1 << 20):
                ids, at = tok.encode(texts[i:k])
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                rows = []
                for doc, a, z in zip(ids_of[i:k], at[:-1].tolist(), at[1:].tolist()):
                    n, p, s = z - a + 1, 0, 0
                    while s < n:  # the first piece takes what full pieces leave
                        e = s + ((n - s - 1) % size + 1)
                        part = raw[4 * (a + s):4 * min(a + e, z)]
                        rows.append((doc, p, s, e - s, zlib.crc32(end, zlib.crc32(part)) if e == n else zlib.crc32(part)))
                        p, s = p + 1, e
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(pieces, _PIECE)


class _Left:
    """How many pieces of each length are left; ``up`` has bit x, ``down`` bit
    ``size - x`` set where pieces of length x are."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.size = size
        self.count = np.bincount(lengths, minlength=size + 1).tolist()
        self.up = self.down = 0
        for x in np.unique(lengths).tolist():
            self._flip(x)

    def _flip(self, x: int) -> None:
        self.up ^= 1 << x
        self.down ^= 1 << (self.size - x)

    def take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            self._flip(x)

    def give(self, x: int) -> None:
        if not self.count[x]:
            self._flip(x)
        self.count[x] += 1

    def longest(self, most: int) -> int:
        """The longest length left of at most ``most``, else 0."""
        return max(0, (self.up & ((2 << most) - 1)).bit_length() - 1)

    def two(self, most: int, above: int) -> tuple[int, int] | None:
        """Two lengths left whose sum is largest, over ``above`` and at most ``most``."""
        for total in range(most, above, -1):
            both = self.up & (self.down >> (self.size - total))  # bit x: x and total - x are left
            if both and total % 2 == 0 and self.count[total // 2] < 2:
                both &= ~(1 << (total // 2))
            if both:
                x = both.bit_length() - 1
                return x, total - x
        return None


def pack_two_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence of each piece, offset in it)`` for pieces of 1 to ``size`` ids."""
    lengths = np.asarray(lengths, dtype=np.int64)
    left, sequences = _Left(lengths, size), []
    while left.up:
        gap, held = size, []
        while gap and (x := left.longest(gap)):
            left.take(x)
            held.append(x)
            gap -= x
        if gap and len(held) > 1:
            smallest = held[-1]
            pair = left.two(gap + smallest, smallest)
            if pair:
                left.give(smallest)
                held[-1:] = pair
                for x in pair:
                    left.take(x)
        sequences.append(held)
    # pieces of one length are alike: deal them out in order
    flat = np.array([x for held in sequences for x in held], dtype=np.int64)
    of = np.repeat(np.arange(len(sequences)), [len(held) for held in sequences])
    ends = np.cumsum(flat)
    first = np.searchsorted(of, np.arange(len(sequences)))
    offset = ends - flat - (ends - flat)[first][of] if len(flat) else flat
    sequence, place = np.empty(len(flat), dtype=np.int64), np.empty(len(flat), dtype=np.int64)
    mine, theirs = np.argsort(lengths, kind="stable"), np.argsort(flat, kind="stable")
    sequence[mine], place[mine] = of[theirs], offset[theirs]
    return sequence, place


def pack_documents(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None, group_pieces: int = GROUP_PIECES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece: ``doc_id, piece,
    start, length, ids_crc32, sequence_id, offset``."""
    pieces = cut_documents(id_and_text(docs, id_col, text_col), size, vocabulary).withColumn("row_key", F.monotonically_increasing_id())
    pieces, n = write_stage(pieces, "two-fit-pieces")
    groups = max(1, -(-n // group_pieces))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32", "row_key"], kind="stable").reset_index(drop=True)
        sequence, offset = pack_two_fit(rows["length"].to_numpy(), size)
        return rows.assign(sequence_id=rows["g"].to_numpy() * (1 << 32) + sequence, offset=offset).drop(columns=["row_key", "g"])

    full = pieces.where(F.col("length") == size).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row_key")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    short = pieces.where(F.col("length") < size).withColumn("g", F.pmod(F.xxhash64("row_key"), F.lit(groups)))
    return short.groupBy("g").applyInPandas(pack, f"{_PIECE}, sequence_id bigint, offset bigint").unionByName(full)
