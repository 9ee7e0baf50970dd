"""Filter interaction audit over a sparse document-term matrix.

1. Blocks of documents become CSR shards with a dictionary of their own (Arrow
   dictionary encoding of the block's words; one row a shard). The same pass
   takes what the other filters need: upper-case letters, odd characters, a
   128-bit digest of the text.
2. The shards' words (each at most once a shard, so no word is a hot key),
   packed by a hash of the word, meet in its bucket. A task numbers the words
   of its buckets as it meets them, holding each distinct word once; totals of
   the tasks make the numbers dense.
3. Numbers return to their shards packed, and replace the shard's own:
   :class:`TermMatrix`.
4. Row sums and nonzero counts of the matrix decide A and B. The other flags
   join per document, then only counts per (part, set of failed filters)
   remain: 32 rows a part, from which every order of the filters follows.

Defined cases: a null text is the empty text; a null ``lang`` belongs to part
``''``; a null ``doc_id`` is smaller than none and fails E never, no label
belongs to it; repeated rows are separate documents, and of equal ids none is
smaller; a document with several label rows is good (toxic) if any of them
says 1; an empty table has no parts; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import islice, permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petalframe.llm.common import small_side, write_stage
from petalframe.llm.words import _BYTE, _BYTES, _SEPARATOR, _segment_hashes, mix

FILTERS = "ABCDE"
#: Characters of text in a shard, about (one longer text stands alone); words in a row of the dictionary.
SHARD_CHARS, DICTIONARY_ROW = 4_000_000, 100_000
_WHITE, _UPPER, _ODD = b" \t\n\x0b\x0c\r", bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"
_C, _D = 4, 8

_SHARD = "shard bigint, doc_id array<bigint>, part array<string>, flags array<int>, digest array<binary>, indptr binary, terms binary, counts binary"


@dataclass
class TermMatrix:
    """``shards``: one row per CSR shard: ``shard``, per row of it ``doc_id, part,
    flags, digest``, and zstd-packed ``indptr`` (int64), ``terms`` (int64 global
    ids), ``counts`` (int32). ``terms``: ``term_id`` (dense from 0), ``word``."""

    shards: DataFrame
    terms: DataFrame


def _encode_words(raw: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``(words, indptr, own number, count)``: the dictionary of a block's words
    and its CSR rows."""
    data = b" ".join(raw) + b" "
    buf = np.frombuffer(data, dtype=np.uint8)
    gap = np.empty(len(buf) + 1, dtype=bool)
    gap[0], gap[1:] = True, _SEPARATOR[buf]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    flat = data.translate(None, _WHITE)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()
    own = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = max(1, len(words.dictionary))
    at = np.cumsum([0] + [len(r) + 1 for r in raw])
    row = np.repeat(np.arange(len(raw), dtype=np.int64), np.diff(np.searchsorted(starts, at)))
    key = row * n + own
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    cells = key[first]
    indptr = np.searchsorted(cells, np.arange(len(raw) + 1, dtype=np.int64) * n)
    return words.dictionary, indptr, cells % n, np.diff(np.concatenate([first, [len(key)]]))


def _pack(x: np.ndarray, dtype: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.astype(dtype).tobytes())


def _unpack(z: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(z), dtype=dtype)


def _by_bucket(words: pa.Array, buckets: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """The words dealt to buckets by their hash: bucket, words (packed, joined by
    a blank) and their places in ``words``."""
    if not len(words):
        return [], [], []
    at = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    h = mix(_segment_hashes(lambda a, b: _BYTE[data[a:b]], at[:-1], at[1:], _BYTES)) % np.uint64(buckets)
    order = np.argsort(h, kind="stable")
    h = h[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    runs, dealt = list(zip(edge[:-1].tolist(), edge[1:].tolist())), words.take(pa.array(order)).to_pylist()
    pack = zstandard.ZstdCompressor(level=1)
    return h[edge[:-1]].astype(np.int64).tolist(), [pack.compress(b" ".join(dealt[a:z])) for a, z in runs], [_pack(order[a:z], "<u4") for a, z in runs]


def _local_shards(docs: DataFrame, shard_chars: int, buckets: int) -> DataFrame:
    def build(batches):
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def shard():
            raw = [t.encode("utf-8", "surrogatepass") for _, t, _ in held]
            words, indptr, own, count = _encode_words(raw)
            flags = [_C * (100 * (len(r) - len(r.translate(None, _UPPER))) > 3 * len(t)) + _D * (len(r.translate(None, _ODD)) < len(r))
                     for r, (_, t, _) in zip(raw, held)]
            bucket, packed, pos = _by_bucket(words, buckets)
            row = {"shard": pa.array([(task << 32) + n], pa.int64()),
                   "doc_id": pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                   "part": pa.array([[p for _, _, p in held]], pa.list_(pa.string())),
                   "flags": pa.array([flags], pa.list_(pa.int32())),
                   "digest": pa.array([[hashlib.blake2b(r, digest_size=16).digest() for r in raw]], pa.list_(pa.binary())),
                   "indptr": pa.array([_pack(indptr, "<i8")], pa.binary()), "terms": pa.array([_pack(own, "<i4")], pa.binary()),
                   "counts": pa.array([_pack(count, "<i4")], pa.binary()), "bucket": pa.array([bucket], pa.list_(pa.int64())),
                   "words": pa.array([packed], pa.list_(pa.binary())), "pos": pa.array([pos], pa.list_(pa.binary()))}
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for b in batches:
            for doc, text, part in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "part"))):
                if held and size + len(text) > shard_chars:
                    yield shard()
                    n, held, size = n + 1, [], 0
                held.append((doc, text, part))
                size += len(text)
        if held:
            yield shard()

    return docs.mapInArrow(build, f"{_SHARD}, bucket array<bigint>, words array<binary>, pos array<binary>")


def _numbered(words: DataFrame) -> DataFrame:
    """Packed words ``(shard, words, pos)`` to ``(part, shard, pos, ids)``, with
    numbers given in this task (``part``); rows without a shard list the task's
    words by number, from ``first`` on."""

    def number(batches):
        part, known, unpack = TaskContext.get().partitionId(), {}, zstandard.ZstdDecompressor()
        for b in batches:
            ids = []
            for z in b.column("words").to_pylist():
                own = unpack.decompress(z).split(b" ")
                ids.append(_pack(np.fromiter((known.setdefault(w, len(known)) for w in own), dtype=np.int64, count=len(own)), "<i8"))
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int64()), b.column("shard"), b.column("pos"), pa.array(ids, pa.binary()), none,
                 pa.nulls(len(ids), pa.list_(pa.string()))], ["part", "shard", "pos", "ids", "first", "words"])
        listed = iter(known)
        for first in range(0, len(known), DICTIONARY_ROW):
            block = pa.array(list(islice(listed, DICTIONARY_ROW)), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                 pa.array([first], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), block)],
                ["part", "shard", "pos", "ids", "first", "words"])

    return words.mapInArrow(number, "part bigint, shard bigint, pos binary, ids binary, first bigint, words array<string>")


def term_matrix(docs: DataFrame, shard_chars: int = SHARD_CHARS, buckets: int | None = None, id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "lang") -> TermMatrix:
    """The document-term matrix of ``docs`` (every row, every word). A task holds
    the distinct words of its buckets: as many buckets as shuffle partitions, by default."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                         F.coalesce(F.col(part_col), F.lit("")).alias("part"))
    local, _ = write_stage(_local_shards(narrow, shard_chars, buckets), "csr-local")
    words = local.select("shard", F.explode(F.arrays_zip("bucket", "words", "pos")).alias("w")).select("shard", "w.*")
    coded, _ = write_stage(_numbered(words.repartition("bucket").drop("bucket")), "csr-terms")
    # one total per task: the driver holds as many numbers as there are tasks
    totals = coded.where("shard IS NULL").groupBy("part").agg(F.max(F.col("first") + F.size("words")).alias("n")).orderBy("part").collect()
    ends = np.cumsum([0] + [r["n"] for r in totals])
    base = {r["part"]: int(e) for r, e in zip(totals, ends)}

    def globally(shard: pd.DataFrame, ids: pd.DataFrame) -> pd.DataFrame:
        number = np.empty(int(sum(len(_unpack(z, "<u4")) for z in ids["pos"])), dtype=np.int64)
        for part, pos, own in zip(ids["part"], ids["pos"], ids["ids"]):
            number[_unpack(pos, "<u4")] = _unpack(own, "<i8") + base[part]
        shard["terms"] = [_pack(number[_unpack(z, "<i4")], "<i8") for z in shard["terms"]]
        return shard

    rows = local.drop("bucket", "words", "pos").groupBy("shard").cogroup(
        coded.where("shard IS NOT NULL").select("shard", "part", "pos", "ids").groupBy("shard"))
    start = F.broadcast(docs.sparkSession.createDataFrame(list(base.items()), "part bigint, start bigint"))
    terms = coded.where("shard IS NULL").select("part", "first", F.posexplode("words").alias("i", "word")).join(start, "part")
    return TermMatrix(rows.applyInPandas(globally, _SHARD), terms.select((F.col("start") + F.col("first") + F.col("i")).alias("term_id"), "word"))


def row_statistics(matrix: TermMatrix) -> DataFrame:
    """Per matrix row: ``doc_id, part, flags, digest``, ``n_words`` (row sum) and
    ``n_distinct`` (nonzero cells)."""

    def rows(batches):
        for b in batches:
            for i in range(b.num_rows):
                indptr, count = (_unpack(b.column(c)[i].as_py(), t) for c, t in (("indptr", "<i8"), ("counts", "<i4")))
                total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
                lists = [b.column(c)[i].values for c in ("doc_id", "part", "flags", "digest")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(np.diff(total[indptr])), pa.array(np.diff(indptr))],
                                                 ["doc_id", "part", "flags", "digest", "n_words", "n_distinct"])

    return matrix.shards.mapInArrow(rows, "doc_id bigint, part string, flags int, digest binary, n_words bigint, n_distinct bigint")


def failed_filters(docs: DataFrame, min_words: int = 200, **columns) -> DataFrame:
    """Per document ``doc_id, part, failed``: bit k of ``failed`` is filter k of
    ``FILTERS``, judged on the whole table."""
    rows, _ = write_stage(row_statistics(term_matrix(docs, **columns)), "filter-rows")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    copies, _ = small_side(copies.select("digest", "first_id"), "filter-copies")
    rows = rows.join(copies, "digest", "left")

    def bit(k: int, fails: Column) -> Column:
        return F.when(F.coalesce(fails, F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0))

    failed = (bit(0, F.col("n_words") < min_words) + bit(1, 100 * F.col("n_distinct") < 50 * F.col("n_words"))
              + F.col("flags") + bit(4, F.col("first_id") < F.col("doc_id")))
    return rows.select("doc_id", "part", failed.alias("failed"))


def _orders() -> list[tuple[str, int, int, int]]:
    """``(filter_order, step, filter, filters before it as bits)`` of every order."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in order)
        out += [(name, s + 1, k, sum(1 << j for j in order[:s])) for s, k in enumerate(order)]
    return sorted(out)


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``: one row per part, order and step."""
    said = [F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")]
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(*said)
    counts = (failed_filters(docs, **columns).join(said, "doc_id", "left").groupBy("part", "failed")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("quality", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))
    # a step depends on its filter and the set of filters before it: 80 cases a part
    cases = sorted({(k, before) for _, _, k, before in _orders()})
    case = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(before).alias("before")) for k, before in cases]))
    c = counts.withColumn("c", case).select("part", "failed", "n", "good", "toxic", "c.*")
    own = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), F.col("k") + 1)
    fails, earlier = F.col("failed").bitwiseAND(own) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(value: str, when: Column, name: str) -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(F.lit(0))).cast("bigint").alias(name)

    c = c.groupBy("part", "k", "before").agg(
        total("n", ~fails & ~earlier, "kept"), total("n", fails & ~earlier, "removed"), total("n", fails & earlier, "redundant"),
        total("n", F.col("failed") == own, "unique_fails"), total("good", fails & ~earlier, "good_lost"), total("toxic", fails & ~earlier, "toxic_lost"))
    # a set of filters comes before one in so many orders
    orders_of = [factorial(s) * factorial(len(FILTERS) - 1 - s) for s in range(len(FILTERS))]
    weight = F.element_at(F.array(*[F.lit(w) for w in orders_of]), F.bit_count("before") + 1)
    c = c.withColumn("shapley", F.sum(F.col("removed") * weight).over(Window.partitionBy("part", "k")))
    orders = docs.sparkSession.createDataFrame(_orders(), "filter_order string, step int, k int, before int")
    return c.join(F.broadcast(orders), ["k", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
