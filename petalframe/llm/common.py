"""Helpers the operators share: tables, compressed texts, written stages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petalframe.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, _file_bytes, materialize_counted, prepare

#: A word of a text, for Spark's Java regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Session settings. Texts may be long: what travels to Python at a time is
    bounded in rows and bytes."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (bigint ``doc_id``) and the text, whatever else the input holds."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def write_stage(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` once under the shared checkpoint folder; the reread frame
    and its row count. Cuts the lineage: a lost executor rereads the files."""
    return materialize_counted(df, f"llm-{name}")


def small_side(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """:func:`write_stage` of a join's small side, with a broadcast hint (and
    true) if its rows and bytes, counted once written, are within the bounds."""
    out, n = write_stage(df, name)
    fits = n <= BROADCAST_MAX_ROWS and _file_bytes(out) <= BROADCAST_MAX_BYTES
    return (F.broadcast(out) if fits else out), fits


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow took for used-up ones goes back to the system,
    as a worker stays for later stages and holds it otherwise."""
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()


def compress(text: str | None) -> bytes | None:
    return None if text is None else zstandard.ZstdCompressor(level=1).compress(text.encode("utf-8", "surrogatepass"))


def decompress(z: bytes | None) -> str | None:
    return None if z is None else zstandard.ZstdDecompressor().decompress(z).decode("utf-8", "surrogatepass")


def compressed(docs: DataFrame) -> DataFrame:
    """``(doc_id, z)``: texts packed before a shuffle, about a third of their size."""

    def pack(batches):
        for b in batches:
            z = pa.array([compress(t) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), z], ["doc_id", "z"])

    return docs.mapInArrow(pack, "doc_id bigint, z binary")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``(a, b)`` links; a component is
    named by its smallest node.

    Each round a node takes the smallest label among itself and its
    neighbours, then its label's label, so chains shorten by a power of two a
    round. Labels are a written table every round; links and labels stay
    distributed.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, n = write_stage(both, "links")
    labels, _ = write_stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    changed = n
    while changed:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("before"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = new.join(up, "component", "left").select("node", F.least("component", "up").alias("component"), "before")
        labels, _ = write_stage(new, "labels")
        changed = labels.where("component != before").limit(1).count()
        labels = labels.select("node", "component")
    return labels
