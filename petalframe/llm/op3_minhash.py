"""Near-duplicates by bottom-k sketches of one hash function.

A document is the set of its distinct word shingles, as 64-bit hashes; its
sketch is the k smallest of them. For two sets, the k smallest hashes of the
union that both hold are in both sketches, so similar documents share many
retained values. The steps:

1. documents with equal sets become one class (its smallest id stands for it);
2. inverted lists of the retained values (``FIRST`` per class) show how many of
   a class's values any other class holds; classes with too few go no further;
3. the others get longer sketches (``SECOND``; whole sets up to that size).
   With m shared values of which a link needs t, one of the m - t + 1 rarest
   must be common to both sides: only those are listed;
4. in each list every member is compared with the list's centre (the member
   with the largest shared part); members linked to it are connected through
   it and need no pairs among themselves. The others are compared with all
   members of their lists, in blocks of them and parts of the members, so that
   no task holds a whole list;
5. a pair is first estimated from the union sketch, then confirmed on the full
   sets; components follow from the confirmed links.

Losses: sets of fewer than ``threshold * k`` shingles are compared exactly.
Longer ones need at least ``threshold`` of the union's k smallest values, less
six standard deviations; a pair right at the threshold is missed with a
probability of about 1e-8. No cap on lists or partners.

Defined cases: a null or empty text has no shingles and is linked with
nothing; fewer words than a shingle make the whole sequence the only one;
rows with one ``doc_id`` are one document, of which ``keep_one`` keeps the row
with a text and the smallest hash of its columns; a null ``doc_id`` is linked with
nothing, has a null component and is kept; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import components, compressed, decompress, id_and_text, released, write_stage
from petalframe.llm.op1_substring import _emit, _shared
from petalframe.llm.words import Words, grams, mix, signed, small_batches

FIRST, SECOND = 32, 256
SIGMAS = 6.0
#: Documents in a block of sketches, on either side.
OUTSIDE_BLOCK, MEMBER_BLOCK = 128, 1000
#: Characters that are hashed at a time.
HASHED_CHARS = 1 << 19


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's words."""
    if not len(words):
        return words
    return np.unique(grams(words, min(size, len(words))))


def least_shared(k: int, percent: int) -> int:
    """Values of a full sketch that a similar document's sketch shares at least."""
    p = percent / 100
    return max(1, math.floor(k * p - SIGMAS * math.sqrt(k * p * (1 - p))))


def _needed(n: Column, k: int, percent: int) -> Column:
    exact = F.floor((n * percent + 99) / 100)
    return F.when(n * 100 < percent * k, exact).otherwise(F.lit(least_shared(k, percent)))


def _features(docs: DataFrame, size: int, k: int) -> DataFrame:
    def run(batches):
        for b in released(batches):
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for i, e in small_batches(texts, HASHED_CHARS):
                words, rows = Words(texts[i:e], lower=True), []
                for j in range(e - i):
                    s = shingles(words.of(j), size)
                    d1, d2 = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                    rows.append((len(s), int(d1.view(np.int64)), int(d2.view(np.int64)), signed(s[:k])))
                n, d1, d2, sk = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, e - i), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sk, pa.list_(pa.int64()))],
                    ["doc_id", "n", "d1", "d2", "sketch"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, d1 bigint, d2 bigint, sketch array<bigint>")


def _brief(texts: DataFrame, size: int, k: int) -> DataFrame:
    """Add ``brief``: the upper halves of the k smallest shingle hashes, for estimates."""

    def run(batches):
        for b in batches:
            brief = [(shingles(Words([decompress(z)], lower=True).of(0), size)[:k] >> np.uint64(32)).astype(np.uint32).tobytes()
                     for z in b.column("z").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(brief, pa.binary())], [*b.schema.names, "brief"])

    return texts.mapInArrow(run, "rep bigint, n bigint, z binary, brief binary")


def _long_sketches(texts: DataFrame, size: int, k: int) -> DataFrame:
    """``(rep, value)`` rows of the k smallest shingle hashes."""

    def run(batches):
        for b in batches:
            reps, zs = b.column("rep").to_pylist(), b.column("z").to_pylist()
            held = [shingles(Words([decompress(z)], lower=True).of(0), size)[:k] for z in zs]
            at = np.repeat(np.array(reps, dtype=np.int64), [len(h) for h in held])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(signed(np.concatenate(held)) if held else [], pa.int64())], ["rep", "value"])

    return texts.mapInArrow(run, "rep bigint, value bigint")


class _Sets:
    """Shingle sets of the texts last unpacked, up to a number of hashes."""

    def __init__(self, size: int, most: int = 4 << 20):
        self.size, self.most, self.held, self.kept = size, most, 0, {}

    def of(self, z: bytes) -> np.ndarray:
        if z not in self.kept:
            s = shingles(Words([decompress(z)], lower=True).of(0), self.size)
            if self.held + len(s) > self.most:
                self.held, self.kept = 0, {}
            self.held += len(s)
            self.kept[z] = s
        return self.kept[z]


def _may_link(x: np.ndarray, y: np.ndarray, nx: int, ny: int, k: int, percent: int) -> bool:
    """Union-sketch estimate of two sorted sketches: whether the k smallest
    values of the union hold enough that are in both."""
    z = np.sort(np.concatenate([x, y]), kind="stable")
    twice = z[1:] == z[:-1]
    union = len(z) - int(twice.sum())
    if nx <= k and ny <= k:  # whole sets; equal upper halves may merge a value or two
        return 100 * (int(twice.sum()) + 2) >= percent * union
    rank = np.arange(1, len(z)) - np.cumsum(np.r_[0, twice[:-1]])
    p, most = percent / 100, min(nx, ny) * 100 / percent
    spread = math.sqrt(k * p * (1 - p) * max(0.0, 1 - k / max(most, k)))
    return int((twice & (rank <= k)).sum()) + 2 >= k * p - SIGMAS * spread


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int, k: int = SECOND) -> DataFrame:
    """Of ``(a, b)`` pairs those whose full sets are similar enough."""

    def run(batches):
        sets = _Sets(size)
        for batch in batches:
            keep = []
            for a, b, za, zb, sa, sb, na, nb in zip(*(c.to_pylist() for c in batch.columns)):
                if not _may_link(np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32), na, nb, k, percent):
                    continue
                s, t = sets.of(za), sets.of(zb)
                common = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * common >= percent * (len(s) + len(t) - common):
                    keep.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*keep) if keep else ((), ()))], ["a", "b"])

    side = [texts.select(F.col("rep").alias(x), F.col("z").alias(f"z{x}"), F.col("brief").alias(f"s{x}"), F.col("n").alias(f"n{x}")) for x in "ab"]
    return (pairs.join(side[0], "a").join(side[1], "b").sortWithinPartitions("b", "a").select("a", "b", "za", "zb", "sa", "sb", "na", "nb")
            .mapInArrow(run, "a bigint, b bigint"))


def _links(reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links between classes: ``(a, b)`` by their smallest ids."""
    # classes whose short sketch shares enough values with others
    def values(batches):
        def per_class():
            for b in batches:
                sk = b.column("sketch")
                for r, rep in enumerate(b.column("rep").to_pylist()):
                    yield sk[r].values.to_numpy().view(np.uint64), rep
        return _emit(per_class(), True)

    shared = _shared(reps.mapInArrow(values, "h bigint, doc_id bigint, closed boolean"), True)
    found = shared.distinct().groupBy(F.col("doc_id").alias("rep")).agg(F.count(F.lit(1)).alias("m"))
    cand = reps.join(found, "rep").where(F.col("m") >= _needed(F.col("n"), FIRST, percent)).select("rep", "n")
    texts = compressed(docs).join(cand, F.col("doc_id") == F.col("rep")).select("rep", "n", "z")
    texts, _ = write_stage(_brief(texts, size, SECOND), "near-texts")

    # longer sketches of those; the rarest shared values of each are listed
    longer, _ = write_stage(_long_sketches(texts, size, SECOND).distinct(), "near-values")
    often = longer.groupBy("value").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    per = (longer.join(often, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("f", "value"))).alias("vs"))
           .join(texts.groupBy("rep").agg(F.min("n").alias("n")), "rep").withColumn("m", F.size("vs"))
           .withColumn("t", _needed(F.col("n"), SECOND, percent)).where("m >= t"))
    part = F.col("m") / F.least(F.col("n"), F.lit(SECOND))
    first = F.slice("vs", F.lit(1), (F.col("m") - F.col("t") + 1).cast("int"))
    lists = per.select("rep", "n", part.alias("part"), F.explode(first).alias("v")).select(F.col("v.value").alias("value"), "rep", "part")
    lists, _ = write_stage(lists, "near-lists")

    # every member against the centre of its list
    by = F.struct("part", (-F.col("rep")).alias("minus"))
    centre = lists.groupBy("value").agg(F.max(by).alias("c"), F.count(F.lit(1)).alias("members")).where("members > 1")
    at = lists.join(centre.select("value", (-F.col("c.minus")).alias("centre"), "members"), "value")
    at = at.withColumn("a", F.least("rep", "centre")).withColumn("b", F.greatest("rep", "centre"))
    pairs, _ = write_stage(at.where("rep != centre").select("a", "b").distinct(), "near-pairs")
    close, _ = write_stage(_confirm(pairs, texts, size, percent), "near-close")
    linked = at.join(close.withColumn("linked", F.lit(True)), ["a", "b"], "left")
    inside = (F.col("rep") == F.col("centre")) | F.coalesce(F.col("linked"), F.lit(False))
    lists, _ = write_stage(linked.select("value", "rep", "members", inside.alias("inside")), "near-marked")

    # who is outside meets all members of its lists
    more = _across(lists, texts, percent).join(pairs, ["a", "b"], "left_anti")
    return close.union(_confirm(more, texts, size, percent)).distinct()


def _met(lists: DataFrame, home: DataFrame, member_block: int = MEMBER_BLOCK) -> DataFrame:
    """``(home, block, salt, parts, rep)``: members of the lists of a block's
    documents, each once, dealt to the block's salts by a hash of the member."""
    parts = F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / member_block))
    packed = lists.groupBy("value", parts.alias("part")).agg(F.collect_list("rep").alias("reps")).drop("part")
    needs = lists.where("not inside").join(home, "rep").select("home", "block", "salts", "value").distinct().join(packed, "value")

    def deal(batches):
        for b in batches:
            reps = b.column("reps")
            found = reps.flatten().to_numpy()
            row = np.repeat(np.arange(len(reps)), np.diff(reps.offsets.to_numpy()))
            home, block, salts = (b.column(c).to_numpy() for c in ("home", "block", "salts"))
            salt = (mix(found.astype(np.uint64)) % salts[row].astype(np.uint64)).astype(np.int64)
            order = np.lexsort((salt, row))
            found, row, salt = found[order], row[order], salt[order]
            cuts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (salt[1:] != salt[:-1])]) if len(row) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(home[row[cuts]]), pa.array(block[row[cuts]]), pa.array(salt[cuts]),
                 pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(row)], pa.int32()), pa.array(found, pa.int64()))], ["home", "block", "salt", "reps"])

    def members(batches):
        """Rows of a block and salt come together; each of its members goes out once."""
        now, found = None, []

        def out():
            y = np.unique(np.concatenate(found))
            same = [np.full(len(y), v, dtype=np.int64) for v in (*now, -(-len(y) // member_block))]
            return pa.RecordBatch.from_arrays([*[pa.array(v) for v in same], pa.array(y)], ["home", "block", "salt", "parts", "rep"])

        for b in batches:
            reps = b.column("reps")
            for r, key in enumerate(zip(*(b.column(c).to_pylist() for c in ("home", "block", "salt")))):
                if key != now and found:
                    yield out()
                    found = []
                now = key
                found.append(np.unique(reps[r].values.to_numpy()))
                if len(found) > 64:
                    found = [np.unique(np.concatenate(found))]
        if found:
            yield out()

    dealt = needs.select("home", "block", "salts", "reps").mapInArrow(deal, "home bigint, block bigint, salt bigint, reps array<bigint>")
    return (dealt.repartition("home", "block", "salt").sortWithinPartitions("home", "block", "salt")
            .mapInArrow(members, "home bigint, block bigint, salt bigint, parts bigint, rep bigint"))


def _across(lists: DataFrame, texts: DataFrame, percent: int, k: int = SECOND, member_block: int = MEMBER_BLOCK) -> DataFrame:
    """``(a, b)``: members outside the connected part of a list with any member
    of it, where the sketches allow a link.

    Outsiders with the same largest list make blocks; a block needs each member
    of its lists once, whichever of its documents share the list with it. Both
    meet in salted parts of the members.
    """
    outside = lists.where("not inside")
    home = outside.groupBy("rep").agg(F.max(F.struct("members", "value")).alias("h"))
    # no other list of the block's documents is longer than its home
    home = home.select("rep", F.col("h.value").alias("home"), F.ceil(F.col("h.members") / member_block).alias("salts"))
    blocks = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / OUTSIDE_BLOCK).alias("blocks"))
    home = home.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).select("rep", "home", "block", "salts")
    home, _ = write_stage(home, "near-home")
    doc = F.struct("rep", "n", "brief")
    xs = (home.join(texts, "rep").groupBy("home", "block", "salts").agg(F.collect_list(doc).alias("xs"))
          .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
    ys = (_met(lists, home, member_block).join(texts, "rep").groupBy("home", "block", "salt", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"))
          .agg(F.collect_list(doc).alias("ys")))

    def estimate(batches):
        for b in batches:
            found: list[tuple[int, int]] = []
            for xs, ys in zip(b.column("xs").to_pylist(), b.column("ys").to_pylist()):
                ys = [(y["rep"], y["n"], np.frombuffer(y["brief"], np.uint32)) for y in ys]
                ends = np.cumsum([len(y[2]) for y in ys])
                flat = np.concatenate([y[2] for y in ys])
                n = np.array([y[1] for y in ys])
                for x in xs:
                    sketch = np.frombuffer(x["brief"], np.uint32)
                    at = np.minimum(np.searchsorted(sketch, flat), len(sketch) - 1)
                    hits = np.cumsum(sketch[at] == flat)[ends - 1]
                    shared = np.diff(np.r_[0, hits])
                    # no link without as many common values as the smaller sketch needs
                    least = np.minimum(np.minimum(n, x["n"]) * percent / 100, least_shared(k, percent)) - 2
                    fits = (np.minimum(n, x["n"]) * 100 >= np.maximum(n, x["n"]) * percent) & (shared >= least)
                    for i in np.flatnonzero(fits).tolist():
                        rep, ny, other = ys[i]
                        if rep != x["rep"] and _may_link(sketch, other, x["n"], ny, k, percent):
                            found.append((min(rep, x["rep"]), max(rep, x["rep"])))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))], ["a", "b"])

    return ys.join(xs, ["home", "block", "salt"]).select("xs", "ys").mapInArrow(estimate, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, class_id`` (smallest id with
    the same set), ``component_id`` (smallest id reachable over links of at
    least ``percent`` similarity), ``kept`` (the document is its component's
    smallest)."""
    docs = id_and_text(docs, id_col, text_col)
    feats, _ = write_stage(_features(docs, shingle, FIRST), "near-features")
    key = ["d1", "d2", "n"]
    classes = feats.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classes, _ = write_stage(classes, "near-sets")  # a table of its own: joins with hot sets can be split
    members, _ = write_stage(feats.select("doc_id", *key).join(classes, key, "left")
                             .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "near-members")
    reps, _ = write_stage(feats.join(classes, key).where("doc_id = rep").select("rep", "n", "sketch"), "near-classes")
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    comp = components(_links(reps, known, shingle, percent))
    return (members.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns, of each component's rows one (rows without an id all stay)."""
    hashed = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    first = F.struct(F.col(text_col).isNull(), F.xxhash64(*hashed))
    kept = near_duplicates(docs, shingle, percent, id_col, text_col).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    rows = docs.join(kept, F.col(id_col) == F.col("_kept_id")).drop("_kept_id")
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(F.struct(*docs.columns), first).alias("_row")).select("_row.*")
    return rows.union(docs.where(F.col(id_col).isNull()))
