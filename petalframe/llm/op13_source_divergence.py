"""Source divergence audit by single-pass in-memory indexing.

1. Every task holds documents until ``BLOCK_CHARS`` characters fill its memory,
   then builds the block's postings (per language, term to sources with their
   occurrences, and document frequency) and spills them as term-sorted runs, one
   per language and hash shard, in chunks of at most ``CHUNK_TERMS`` terms.
2. Runs of a shard are merged, ``FAN_IN`` at a time. Chunks arrive by their first
   term; a heap of open chunks by their last term tells which are used up. What
   lies before the newest first term is final and added up in one go whenever
   ``MERGE_TERMS`` entries are open, so a merge holds that many and the chunks
   that overlap. With more runs, merged runs are merged again. The last merge
   drops terms of fewer than ``min_docs`` documents.
3. Shares and divergences are exact integer arithmetic. A pair's sum over all
   V terms is that of two groups without any term, corrected by what each
   group's own terms change (from counts of equal shares, per group) and by the
   terms that both hold. Only the last corrections look at pairs of sources in
   a term: streamed in numpy, summed inside a batch before they leave it.

Defined cases: null text, ``lang`` and ``source`` are ``''``; every row is a
document, repeated ids and rows as well; a group without terms has no ``term``
rows, its ``pair`` values are 0 if its language keeps no term; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petalframe.llm.common import small_side, write_stage
from petalframe.llm.words import _BYTE, _BYTES, _segment_hashes, mix

MIN_DOCS, TOP_TERMS = 3, 200
#: Characters of a block; terms in a chunk of a run; runs one merge reads; entries it holds before it adds up.
BLOCK_CHARS, CHUNK_TERMS, FAN_IN, MERGE_TERMS = 8_000_000, 4_000, 512, 400_000
#: Pair cells that one batch of corrections holds.
PAIR_CELLS = 1 << 21

#: A-Z to a-z; whatever is neither a letter nor beyond ASCII ends a term.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_RUNS = ("lang string, shard int, run bigint, first binary, terms array<binary>, df array<bigint>, sizes array<int>, "
         "names array<string>, codes array<int>, counts array<bigint>")


def term_bytes(text: str) -> bytes:
    """The terms of a text, in order, as UTF-8, between blanks."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES)


@dataclass
class Postings:
    """Entries of one language: ``terms`` (binary), ``df``, how many postings each
    has (``sizes``), and the postings: ``codes`` into ``names`` and ``counts``."""

    terms: pa.Array
    df: np.ndarray
    sizes: np.ndarray
    codes: np.ndarray
    counts: np.ndarray
    names: list

    @cached_property
    def at(self) -> np.ndarray:
        """Where each entry's postings start, and the end."""
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def part(self, a: int, z: int) -> "Postings":
        z = min(z, len(self.terms))
        own = slice(self.at[a], self.at[z])
        return Postings(self.terms[a:z], self.df[a:z], self.sizes[a:z], self.codes[own], self.counts[own], self.names)

    def take(self, order: np.ndarray) -> "Postings":
        sizes = self.sizes[order]
        own = np.repeat(self.at[:-1][order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return Postings(self.terms.take(pa.array(order)), self.df[order], sizes, self.codes[own], self.counts[own], self.names)

    def where(self, keep: np.ndarray) -> "Postings":
        own = np.repeat(keep, self.sizes)
        return Postings(self.terms.filter(pa.array(keep)), self.df[keep], self.sizes[keep], self.codes[own], self.counts[own], self.names)

    def lists(self, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(self.at, pa.int32()), values)


def _runs_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, first, key)``: an order that sorts ``key``, where each value starts in it, the values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    return order, first, key[first]


def _sorted_terms(terms: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms in order, and each entry's place among them."""
    encoded = terms.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return encoded.dictionary.take(pa.array(order)), rank[encoded.indices.to_numpy(zero_copy_only=False)]


def _chunks(lang: str, shard: int, run: int, p: Postings):
    """Record batches (one row each) of sorted entries."""
    for a in range(0, len(p.terms), CHUNK_TERMS):
        c = p.part(a, a + CHUNK_TERMS)

        def one(values, kind):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind) if not isinstance(values, pa.Array) else values)

        yield pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([shard], pa.int32()), pa.array([run], pa.int64()), pa.array([c.terms[0].as_py()], pa.binary()),
             one(c.terms.cast(pa.binary()), None), one(c.df, pa.int64()), one(c.sizes, pa.int32()), one(c.names, pa.string()),
             one(c.codes, pa.int32()), one(c.counts, pa.int64())],
            ["lang", "shard", "run", "first", "terms", "df", "sizes", "names", "codes", "counts"])


def block_postings(texts: list[bytes], sources: list[str]) -> Postings:
    """Postings of documents (term bytes from :func:`term_bytes`) of one language, sorted by
    term; the empty term counts documents."""
    data = b" ".join(texts) + b" "
    buf = np.frombuffer(data, dtype=np.uint8)
    gap = np.empty(len(buf) + 1, dtype=bool)
    gap[0], gap[1:] = True, buf == 0x20
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, b" "))])
    terms, code = _sorted_terms(words)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    docs = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, at)))
    names = {s: k for k, s in enumerate(dict.fromkeys(sources))}
    source = np.array([names[s] for s in sources], dtype=np.int64)
    # the empty term, once a document, before all others
    terms = pa.concat_arrays([pa.array([b""], terms.type), terms])
    code, docs = np.concatenate([np.zeros(len(texts), dtype=np.int64), code + 1]), np.concatenate([np.arange(len(texts)), docs])
    _, _, cells = _runs_of(code * len(texts) + docs)
    df = np.bincount(cells // len(texts), minlength=len(terms))
    _, first, key = _runs_of(code * len(names) + source[docs])
    counts = np.diff(np.concatenate([first, [len(code)]]))
    return Postings(terms, df, np.bincount(key // len(names), minlength=len(terms)), key % len(names), counts, list(names))


def _shard_of(terms: pa.Array, shards: int) -> np.ndarray:
    at = np.frombuffer(terms.buffers()[1], dtype=np.int64)[terms.offset:terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], dtype=np.uint8)
    return (mix(_segment_hashes(lambda a, b: _BYTE[data[a:b]], at[:-1], at[1:], _BYTES)) % np.uint64(shards)).astype(np.int64)


def block_runs(docs: DataFrame, shards: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Sorted runs of ``(text, lang, source)``."""

    def index(batches):
        run, size = TaskContext.get().partitionId() << 32, 0
        held: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))

        def spill():
            for lang in sorted(held):
                p = block_postings(*held[lang])
                shard = _shard_of(p.terms, shards)
                order, first, found = _runs_of(shard)  # by shard, and by term inside
                p, ends = p.take(order), [*first.tolist()[1:], len(order)]
                for k, a, z in zip(found.tolist(), first.tolist(), ends):
                    yield from _chunks(lang, k, run, p.part(a, z))

        for b in batches:
            for text, lang, source in zip(*(b.column(c).to_pylist() for c in ("text", "lang", "source"))):
                texts, sources = held[lang]
                texts.append(term_bytes(text))
                sources.append(source)
                size += len(text)
                if size >= block_chars:
                    yield from spill()
                    run, size = run + 1, 0
                    held.clear()
        yield from spill()

    return docs.mapInArrow(index, _RUNS)


def _added_up(parts: list[Postings], names: list) -> Postings:
    """Entries of several runs (codes into the same ``names``) with equal terms added up."""
    terms, code = _sorted_terms(pa.concat_arrays([p.terms for p in parts]))
    df, sizes, codes, counts = (np.concatenate([getattr(p, c) for p in parts]) for c in ("df", "sizes", "codes", "counts"))
    order, first, _ = _runs_of(code)
    df = np.add.reduceat(df[order], first) if len(first) else df
    order, first, key = _runs_of(np.repeat(code, sizes) * max(1, len(names)) + codes)
    counts = np.add.reduceat(counts[order], first) if len(first) else counts
    return Postings(terms, df, np.bincount(key // max(1, len(names)), minlength=len(terms)), key % max(1, len(names)), counts, names)


def _merged(batches, merge_terms: int):
    """``(lang, shard, group)`` and sorted, added-up entries, part by part, of chunks
    sorted by lang, shard, group and first term."""
    heap, key, n, entries, names = [], None, 0, 0, {}

    def take(before: bytes | None):
        """Entries below ``before`` (all, if None): no later chunk can add to them."""
        nonlocal entries
        parts = []
        while heap and (before is None or heap[0][0] < before):  # chunks that are used up
            parts.append(heapq.heappop(heap)[2])
        for i, (last, k, p) in enumerate(heap):
            a = bisect_left(p.terms, before, key=lambda t: t.as_py())
            if a:
                parts.append(p.part(0, a))
                heap[i] = (last, k, p.part(a, len(p.terms)))
        entries -= sum(len(p.terms) for p in parts)
        if parts:
            yield key, _added_up(parts, list(names))

    for b in batches:
        for i in range(b.num_rows):
            lang, shard, group, first = (b.column(c)[i].as_py() for c in ("lang", "shard", "group", "first"))
            if (lang, shard, group) != key:
                yield from take(None)
                key = (lang, shard, group)
                names.clear()
            elif entries >= merge_terms:
                yield from take(first)
            terms = b.column("terms")[i].values
            df, sizes, codes, counts = (b.column(c)[i].values.to_numpy() for c in ("df", "sizes", "codes", "counts"))
            own = np.array([names.setdefault(x, len(names)) for x in b.column("names")[i].as_py()], dtype=np.int64)
            n += 1
            entries += len(terms)
            heapq.heappush(heap, (terms[-1].as_py(), n, Postings(terms, df, sizes, own[codes], counts, [])))
    yield from take(None)


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, shards: int | None = None, block_chars: int = BLOCK_CHARS,
                fan_in: int = FAN_IN, merge_terms: int = MERGE_TERMS) -> DataFrame:
    """``lang, term, df, total, sources, counts``: a row per language and term of at
    least ``min_docs`` documents, and one with the empty term, whose counts are documents."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs, _ = write_stage(block_runs(docs, shards, block_chars), "index-runs")

    def again(batches):
        for (lang, shard, group), p in _merged(batches, merge_terms):
            yield from _chunks(lang, shard, group, p)

    def last(batches):
        for (lang, *_), p in _merged(batches, merge_terms):
            p = p.where((p.df >= min_docs) | pc.equal(pc.binary_length(p.terms), 0).to_numpy(zero_copy_only=False))
            for a in range(0, len(p.terms), CHUNK_TERMS):
                c = p.part(a, a + CHUNK_TERMS)
                total = np.add.reduceat(c.counts, np.cumsum(c.sizes) - c.sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c.terms), pa.string()), c.terms.cast(pa.string()), pa.array(c.df, pa.int64()), pa.array(total, pa.int64()),
                     c.lists(pa.array(c.names, pa.string()).take(pa.array(c.codes))), c.lists(pa.array(c.counts, pa.int64()))],
                    ["lang", "term", "df", "total", "sources", "counts"])

    while True:
        groups = -(-runs.select("run").distinct().count() // fan_in)
        dealt = (runs.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(max(1, groups)))).drop("run").repartition("lang", "shard", "group")
                 .sortWithinPartitions("lang", "shard", "group", "first"))
        if groups <= 1:
            out = dealt.mapInArrow(last, "lang string, term string, df bigint, total bigint, sources array<string>, counts array<bigint>")
            return write_stage(out, "index")[0]
        runs, _ = write_stage(dealt.mapInArrow(again, _RUNS), "index-runs")


def share(count: str, n: str, v: str) -> Column:
    """``1 + floor(10**9 * (count + 1) / (n + v))`` by long division, three digits at
    a time: exact for totals up to 9 * 10**15."""
    m = f"({n} + {v})"
    x = f"({count} + 1) * 1000"
    y = f"(({x}) % {m}) * 1000"
    z = f"(({y}) % {m}) * 1000"
    return F.expr(f"CASE WHEN {v} > 0 THEN 1 + (({x}) div {m}) * 1000000 + (({y}) div {m}) * 1000 + ({z}) div {m} END")


def gap(p: str, q: str) -> str:
    """``floor((p - q)**2 / q)``; shares are at most 10**9 + 1, so nothing overflows."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _both(batches):
    """``lang, a, b, value``: what terms that both sources hold change beyond the
    corrections of either alone, summed per batch."""

    def f(p, q):
        return (p - q) ** 2 // q

    for b in batches:
        for lang, rows in groupby(range(b.num_rows), key=lambda i: b.column("lang")[i].as_py()):
            rows = list(rows)
            part = b.column("held").slice(rows[0], len(rows))
            flat = part.flatten()
            code, p, p0 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("code", "p", "p0"))
            sizes = np.diff(part.offsets.to_numpy())
            first = np.cumsum(sizes) - sizes
            cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            held = 0

            def out():
                a, z, v = (np.concatenate(c) for c in zip(*cells))
                order = np.lexsort((z, a))
                a, z, v = a[order], z[order], v[order]
                edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (z[1:] != z[:-1])]))
                return pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(edge), pa.string()), pa.array(a[edge]), pa.array(z[edge]), pa.array(np.add.reduceat(v, edge))],
                    ["lang", "a", "b", "value"])

            for k in np.unique(sizes[sizes > 1]).tolist():
                terms = first[sizes == k]
                step = max(1, PAIR_CELLS // (k * k))
                lines = max(1, PAIR_CELLS // k)  # of one term with more cells than that
                for t in range(0, len(terms), step):
                    at = terms[t:t + step, None] + np.arange(k)
                    for r in range(0, k, lines):
                        own, other = at[:, r:r + lines, None], at[:, None, :]
                        v = f(p[own], p[other]) - f(p[own], p0[other]) - f(p0[own], p[other]) + f(p0[own], p0[other])
                        ca, cb = np.broadcast_arrays(code[own], code[other])
                        apart = ca != cb
                        cells.append((ca[apart], cb[apart], v[apart]))
                        held += v.size
                        if held >= PAIR_CELLS:
                            yield out()
                            cells, held = [], 0
            if cells:
                yield out()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source", **index) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (every other source
    of the language) and ``term`` (the ``top_terms`` terms the group overuses most)."""
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    freq = frequencies(narrow, min_docs, **index)
    held = freq.where("term != ''").select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"))
    langs = freq.where("term != ''").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = freq.where("term = ''").select("lang", F.explode("sources").alias("source"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = groups.withColumn("code", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint"))
    groups = groups.withColumn("p0", share("0L", "n_group", "v"))
    groups, _ = small_side(groups, "index-groups")
    held = held.join(groups, ["lang", "source"]).withColumn("p", share("n", "n_group", "v"))

    terms = held.withColumn("q", share("total", "n_lang", "v")).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    other = groups.select("lang", F.col("code").alias("other"), F.col("p0").alias("o0"))
    equal = held.groupBy("lang", "code", "p", "p0").agg(F.count(F.lit(1)).alias("m")).join(other, "lang").where("code != other")
    alone = equal.groupBy("lang", "code", "other").agg(
        F.sum(F.expr(f"m * ({gap('p', 'o0')} - {gap('p0', 'o0')})")).alias("as_p"),
        F.sum(F.expr(f"m * ({gap('o0', 'p')} - {gap('o0', 'p0')})")).alias("as_q"))
    as_p = alone.select("lang", F.col("code").alias("a"), F.col("other").alias("b"), F.col("as_p").alias("value"))
    as_q = alone.select("lang", F.col("other").alias("a"), F.col("code").alias("b"), F.col("as_q").alias("value"))
    per_term = held.groupBy("lang", "term").agg(F.collect_list(F.struct("code", "p", "p0")).alias("held")).where(F.size("held") > 1)
    both = per_term.select("lang", "held").mapInArrow(_both, "lang string, a bigint, b bigint, value bigint")
    changes = as_p.unionByName(as_q).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("change"))

    a = groups.select("lang", "source", F.col("code").alias("a"), "p0", "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("code").alias("b"), F.col("p0").alias("q0"))
    pairs = a.join(b, "lang").where("a != b").join(changes, ["lang", "a", "b"], "left")
    value = F.expr(f"CASE WHEN v > 0 THEN v * {gap('p0', 'q0')} + coalesce(change, 0) ELSE 0 END")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("bigint").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)
