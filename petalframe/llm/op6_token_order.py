"""Training-order materialisation of token ids.

The documents' ids (each with an end id) form one stream, in the order of a
keyed hash of the document; the stream is cut into sequences of fixed length,
the last one padded. A keyed Feistel network permutes the sequence numbers;
numbers that leave the range walk on through the permutation until they are
back in it, so every sequence gets exactly one slot of ``0 .. n - 1``. Range
partitions of slots (whole shards, in order) are gathered and written as shards
of a fixed stride: the bytes of slot s are at ``(s % shard_sequences) * stride`` of shard ``s // shard_sequences``,
so a reader that stopped at a slot goes on from there without an index.

Texts are tokenised once, into a written table of compressed ids. Offsets are
running totals over short rows, taken slot by slot of the hash (no global
sort, no task holds more than a slice). Ids then move twice: to meet their
offset, and to their slot.

Defined cases: a null or empty text is the end id alone; an empty table has no
sequences; a null ``doc_id`` hashes as such; repeated rows each take part;
other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petalframe.llm.common import id_and_text, write_stage
from petalframe.llm.op8_packing import END_ID, encode_documents
from petalframe.llm.op10_mixing import running_total, shuffle_key
from petalframe.llm.words import mix

LENGTH, SHARD_SEQUENCES, KEY = 1024, 256, 20240601
ROUNDS = 6
DTYPE = "<u2"


class Permutation:
    """Keyed permutation of ``0 .. n - 1``: a balanced Feistel network over the
    next even number of bits, with cycle-walking back into the range."""

    def __init__(self, n: int, key: int = KEY):
        self.n = n
        self.half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 63)))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        a, b = x >> self.half, x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                a, b = b ^ (mix(a ^ k) & self.mask), a
            else:
                a, b = b, a ^ (mix(b ^ k) & self.mask)
        return (a << self.half) | b

    def _walk(self, x, back: bool) -> np.ndarray:
        y = self._once(np.asarray(x).astype(np.uint64), back)
        out = y >= self.n
        while out.any():
            y[out] = self._once(y[out], back)
            out = y >= self.n
        return y.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, True)


def _encoded(docs: DataFrame, vocabulary: str | None, dtype: str) -> DataFrame:
    """One row per document: ``rid`` (names the row once written), ``nth`` (of
    equal rows in this task), ``doc_id, text_hash, n, ids``."""

    def encode(batches):
        pack = zstandard.ZstdCompressor(level=1)
        task, seen, row = TaskContext.get().partitionId(), {}, 0
        for b in batches:
            out = []
            hashes = b.column("text_hash").to_pylist()
            for (doc, ids), h in zip(encode_documents([b], vocabulary), hashes):
                if ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"token id {ids.max()} does not fit {dtype}")
                nth = seen[doc, h] = seen.get((doc, h), -1) + 1
                out.append(((task << 33) + row, nth, doc, h, len(ids), pack.compress(ids.astype(dtype).tobytes())))
                row += 1
            seen = {k: v for k, v in seen.items() if v} if len(seen) > 200_000 else seen
            if out:
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["rid", "nth", "doc_id", "text_hash", "n", "ids"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        encode, "rid bigint, nth bigint, doc_id bigint, text_hash bigint, n bigint, ids binary")


def training_order(docs: DataFrame, length: int = LENGTH, key: int = KEY, pad_id: int = END_ID, vocabulary: str | None = None,
                   dtype: str = DTYPE, shard_sequences: int = SHARD_SEQUENCES, id_col: str = "doc_id",
                   text_col: str = "text", slice_rows: int = 20_000) -> DataFrame:
    """Every sequence in its slot: ``slot, sequence, n_tokens`` (without
    padding), ``payload`` (``length`` ids as ``dtype``). Partitions hold whole
    shards, sorted by slot."""
    spark = docs.sparkSession
    encoded, n_docs = write_stage(_encoded(id_and_text(docs, id_col, text_col), vocabulary, dtype), "ids")
    short = encoded.select("rid", "n", "text_hash", shuffle_key(F.concat_ws(":", F.lit(key), "doc_id", "text_hash", "nth")).alias("u"))
    slices = max(1, -(-n_docs // slice_rows))
    at = running_total(short, [], F.floor(F.col("u") / F.lit(float(1 << 60)) * slices), [F.col("u"), F.col("text_hash"), F.col("rid")], "n", "total")
    at = at.select("rid", (F.col("total") - F.col("n")).alias("start"))
    total = int(encoded.agg(F.sum("n").alias("t")).first()["t"] or 0)
    n_seq = -(-total // length)
    schema = "slot bigint, sequence bigint, pos int, part binary"
    if not n_seq:
        return spark.createDataFrame([], "slot bigint, sequence bigint, n_tokens int, payload binary")
    width = np.dtype(dtype).itemsize

    def pieces(batches):
        unpack, pack, order = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), Permutation(n_seq, key)
        for b in batches:
            seq, pos, part = [], [], []
            for start, z in zip(b.column("start").to_pylist(), b.column("ids").to_pylist()):
                raw = unpack.decompress(z)
                n, i = len(raw) // width, 0
                while i < n:
                    p = (start + i) % length
                    k = min(n, i + length - p)
                    seq.append((start + i) // length)
                    pos.append(p)
                    part.append(pack.compress(raw[i * width:k * width]))
                    i = k
            if seq:
                slots = order.slot(np.array(seq, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(seq, pa.int64()), pa.array(pos, pa.int32()), pa.array(part, pa.binary())],
                                                 ["slot", "sequence", "pos", "part"])

    filler = np.full(length, pad_id, dtype=dtype).tobytes()

    def whole(batches):
        """Rows sorted by slot and position, streamed; the parts of one sequence are joined."""
        slot, seq, parts, unpack = None, None, [], zstandard.ZstdDecompressor()

        def row():
            raw = b"".join(map(unpack.decompress, parts))
            return slot, seq, len(raw) // width, raw + filler[len(raw):]

        for b in batches:
            rows = []
            for s, q, part in zip(b.column("slot").to_pylist(), b.column("sequence").to_pylist(), b.column("part").to_pylist()):
                if s != slot:
                    if parts:
                        rows.append(row())
                    slot, seq, parts = s, q, []
                parts.append(part)
            if rows:
                yield _rows(rows)
        if parts:
            yield _rows([row()])

    def _rows(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["slot", "sequence", "n_tokens", "payload"])

    cut = encoded.select("rid", "ids").join(at, "rid").mapInArrow(pieces, schema)
    # slots are a permutation of 0 .. n - 1: ranges of whole shards need no sample
    shard, n_shards = F.floor(F.col("slot") / shard_sequences), -(-n_seq // shard_sequences)
    ranges = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (cut.repartitionById(ranges, F.floor(shard * ranges / n_shards).cast("int")).sortWithinPartitions("slot", "pos")
            .mapInArrow(whole, "slot bigint, sequence bigint, n_tokens int, payload binary"))


def shards(sequences: DataFrame, length: int = LENGTH, dtype: str = DTYPE, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """One row per shard from :func:`training_order`: ``shard_id, first_slot,
    n_sequences, stride, payload, crc32``."""
    stride = length * np.dtype(dtype).itemsize

    def gather(batches):
        now, first, held = None, 0, []

        def row():
            raw = b"".join(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((now, pa.int64()), (first, pa.int64()), (len(held), pa.int32()), (stride, pa.int32()),
                                               (raw, pa.binary()), (zlib.crc32(raw), pa.int64()))],
                ["shard_id", "first_slot", "n_sequences", "stride", "payload", "crc32"])

        for b in batches:
            for slot, payload in zip(b.column("slot").to_pylist(), b.column("payload").to_pylist()):
                if slot // shard_sequences != now:
                    if held:
                        yield row()
                    now, first, held = slot // shard_sequences, slot, []
                held.append(payload)
        if held:
            yield row()

    return sequences.mapInArrow(gather, "shard_id bigint, first_slot bigint, n_sequences int, stride int, payload binary, crc32 bigint")


def write_shards(sequences: DataFrame, path: str, length: int = LENGTH, dtype: str = DTYPE,
                 shard_sequences: int = SHARD_SEQUENCES) -> None:
    shards(sequences, length, dtype, shard_sequences).write.mode("errorifexists").parquet(path)


def shard_name(shard_id: int) -> str:
    return f"shard-{shard_id:09d}.bin"


def _crc(fs, path: str) -> int | None:
    """Checksum of a file, None if there is none."""
    if fs.get_file_info(path).type == pa.fs.FileType.NotFound:
        return None
    crc = 0
    with fs.open_input_stream(path) as f:
        while part := f.read(1 << 20):
            crc = zlib.crc32(part, crc)
    return crc


def write_shard_files(sequences: DataFrame, uri: str, length: int = LENGTH, dtype: str = DTYPE,
                      shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """One plain file per shard under ``uri`` (a shared folder that every executor
    reaches: file, hdfs or an object store), and their index, returned and written
    to ``uri/_index``: ``shard_id, first_slot, n_sequences, stride, crc32, file``.

    A file is written under a name of its own and renamed when it is complete: a
    task that is lost, or run twice, leaves whole files only. A shard whose file
    is there with the right checksum is not written again, so a job that was cut
    off goes on where it stopped."""

    def write(batches):
        fs, base = pa.fs.FileSystem.from_uri(uri)
        fs.create_dir(base, recursive=True)
        for b in batches:
            for row in b.to_pylist():
                name = shard_name(row["shard_id"])
                if _crc(fs, f"{base}/{name}") != row["crc32"]:
                    part = f"{base}/.{name}-{uuid.uuid4().hex}"
                    with fs.open_output_stream(part) as f:
                        f.write(row["payload"])
                    fs.move(part, f"{base}/{name}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard_id"]], pa.int64()), pa.array([row["first_slot"]], pa.int64()), pa.array([row["n_sequences"]], pa.int32()),
                     pa.array([row["stride"]], pa.int32()), pa.array([row["crc32"]], pa.int64()), pa.array([name], pa.string())],
                    ["shard_id", "first_slot", "n_sequences", "stride", "crc32", "file"])

    index = shards(sequences, length, dtype, shard_sequences).mapInArrow(
        write, "shard_id bigint, first_slot bigint, n_sequences int, stride int, crc32 bigint, file string")
    index.write.mode("overwrite").parquet(f"{uri.rstrip('/')}/_index")
    return sequences.sparkSession.read.parquet(f"{uri.rstrip('/')}/_index")


class ShardReader:
    """Sequences of written shard files in slot order, from any slot on: slot s
    lies at ``(s % shard_sequences) * stride`` of shard ``s // shard_sequences``."""

    def __init__(self, uri: str, length: int = LENGTH, dtype: str = DTYPE, shard_sequences: int = SHARD_SEQUENCES):
        self.fs, self.base = pa.fs.FileSystem.from_uri(uri)
        self.dtype, self.stride, self.per_shard = np.dtype(dtype), length * np.dtype(dtype).itemsize, shard_sequences

    def read(self, first: int = 0, last: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """``(slot, ids)`` up to before ``last`` (default: to the end)."""
        slot = first
        while last is None or slot < last:
            path = f"{self.base}/{shard_name(slot // self.per_shard)}"
            if self.fs.get_file_info(path).type == pa.fs.FileType.NotFound:
                return
            with self.fs.open_input_file(path) as f:
                f.seek(slot % self.per_shard * self.stride)
                end = (slot // self.per_shard + 1) * self.per_shard
                while slot < (end if last is None else min(end, last)):
                    raw = f.read(self.stride)
                    if not raw:
                        return
                    yield slot, np.frombuffer(raw, self.dtype)
                    slot += 1


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """``slot, payload`` from slot ``first`` up to before ``last``; only shards
    of that range are read, and each slot is cut out of its shard's payload."""
    s = spark.read.parquet(path).where(F.col("first_slot") + F.col("n_sequences") > first)
    if last is not None:
        s = s.where(F.col("first_slot") < last)
    s = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_sequences") - 1)))
    s = s.select((F.col("first_slot") + F.col("i")).alias("slot"), F.expr("substring(payload, i * stride + 1, stride)").alias("payload"))
    return s.where((F.col("slot") >= first) & (F.col("slot") < last if last is not None else F.lit(True)))
