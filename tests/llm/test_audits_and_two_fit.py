"""Filter audit, best-two-fit packing and source divergence against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from tests.llm.test_operators import EXTRA, WORD, corpus, encoded

LETTERS = "ABCDE"


def audited(rows, labels):
    rows = [(i, t or "", la or "") for i, t, la, *_ in rows]
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t] = min(smallest.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = []
    for i, t, part in rows:
        w = WORD.findall(t)
        docs.append((part, i, {k for k, bad in zip(LETTERS, (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and smallest.get(t, i) < i)) if bad}))
    want = {}
    for part in {p for p, *_ in docs}:
        mine, total = [(i, f) for p, i, f in docs if p == part], Counter()
        for order in permutations(LETTERS):
            left, gone = mine, []
            for s, k in enumerate(order):
                out = [d for d in left if k in d[1]]
                redundant = sum(k in f for _, f in gone)
                left, gone = [d for d in left if k not in d[1]], gone + out
                total[k] += len(out)
                want[part, "".join(order), s + 1] = [len(left), len(out), redundant, sum(f == {k} for _, f in mine),
                                                     sum(i in good for i, _ in out), sum(i in toxic for i, _ in out)]
        for (p, order, s), v in want.items():
            if p == part:
                v.append(total[order[s - 1]])
    return want


def op11_rows():
    rows = corpus() + [(700, "Ab#" * 3, "de", None, 1), (701, "Q" * 200_000 + " w" * 300, "de", None, 1), (702, "x $ y", "", None, 1),
                       (703, "é " * 400, "fr", None, 1), (704, " one\x1ctwo " * 200, "fr", None, 1), (90, "é " * 400, None, None, 1)]
    rows += [(800 + k, "the very same short text", "en", "s0", 1) for k in range(40)]
    return rows, [(i, i % 2, int(i % 5 == 0)) for i in range(0, 840, 3)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (5000, 1, 1)]


def test_op11_brute_force(spark, empty_docs):
    from petalframe.llm.op11_filter_audit import audit

    rows, labels = op11_rows()
    docs = spark.createDataFrame([(*r, *[None] * 12) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audited(rows, labels)
    for chars in (16_000_000, 3_000):  # one shard a task, and many
        got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in audit(docs, said, shard_chars=chars).collect()}
        assert got == want
    assert {p for p, *_ in want} == {"", "en", "de", "fr"} and len(want) == 4 * 600
    assert audit(empty_docs, said).count() == 0
    assert audit(docs, said.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


@pytest.fixture(scope="module")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_op11_matrix_holds_every_word(spark):
    from petalframe.llm.op11_filter_audit import _unpack, row_statistics, term_matrix

    rows = corpus()
    m = term_matrix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4), shard_chars=2_000)
    names = {r.term_id: r.word for r in m.terms.collect()}
    assert sorted(names) == list(range(len(names))) and len(set(names.values())) == len(names)
    assert set(names.values()) == {w for _, t, *_ in rows for w in WORD.findall(t or "")}
    got = Counter()
    for s in m.shards.collect():
        indptr, terms, counts = (_unpack(bytes(s[c]), d) for c, d in (("indptr", "<i8"), ("terms", "<i8"), ("counts", "<i4")))
        for k, doc in enumerate(s.doc_id):
            a, z = indptr[k:k + 2]
            got[doc, tuple(sorted((names[x], int(n)) for x, n in zip(terms[a:z].tolist(), counts[a:z])))] += 1
    assert got == Counter((i, tuple(sorted(Counter(WORD.findall(t or "")).items()))) for i, t, *_ in rows)
    assert m.shards.count() > 10
    assert Counter((r.doc_id, r.n_words, r.n_distinct) for r in row_statistics(m).collect()) == Counter(
        (i, len(WORD.findall(t or "")), len(set(WORD.findall(t or "")))) for i, t, *_ in rows)


def test_two_fit_replaces_the_smallest():
    from petalframe.llm.op12_two_fit import pack_two_fit

    def packed(lengths, size):
        sequence, offset = pack_two_fit(np.array(lengths, dtype=np.int64), size)
        held = defaultdict(list)
        for n, s, o in zip(lengths, sequence.tolist(), offset.tolist()):
            held[s].append((o, n))
        for parts in held.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= size
        return sorted(sorted(n for _, n in p) for p in held.values())

    assert packed([6, 3, 2, 2], 10) == [[2, 2, 6], [3]]
    assert packed([6, 3, 2], 10) == [[2], [3, 6]]
    assert packed([10], 10) == [[10]] and packed([], 10) == []
    rng = np.random.default_rng(5)
    for k in range(60):
        size = int(rng.integers(2, 60))
        packed(rng.integers(1, size + 1, int(rng.integers(1, 200))).tolist(), size)
    # never behind first-fit decreasing, near the bound where the lengths allow it
    for low, high in ((1, 2049), (300, 1100), (1, 200), (500, 700)):
        lengths = rng.integers(low, high, 3_000)
        bins = []
        for x in sorted(lengths.tolist(), reverse=True):
            for b, left in enumerate(bins):
                if left >= x:
                    bins[b] -= x
                    break
            else:
                bins.append(2048 - x)
        n = int(pack_two_fit(lengths)[0].max()) + 1
        assert n <= len(bins) * 1.005 + 1 and n >= -(-int(lengths.sum()) // 2048)


def test_op12_every_id_once(spark, empty_docs, monkeypatch):
    from petalframe.llm.op12_two_fit import SIZE, pack_documents

    rows = corpus() + [(900, "word " * 9_000, "en", "s", 1), (901, "a b " * 1024, None, None, 1)]
    docs = spark.createDataFrame([(*r, *[None] * 12) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array(encoded(t), dtype="<u4")
        ends = list(range(len(ids), 0, -SIZE))[::-1]
        for p, (a, z) in enumerate(zip([0, *ends[:-1]], ends)):
            want[i, p, a, z - a, zlib.crc32(ids[a:z].tobytes())] += 1
    for group in (100_000, 20):
        got = pack_documents(docs, group_pieces=group)
        assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        got = got.collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        held = defaultdict(list)
        for r in got:
            held[r.sequence_id].append((r.offset, r.length))
        for parts in held.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= SIZE
    assert pack_documents(empty_docs).count() == 0


TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergences(rows, top=200):
    docs = [(la or "", s or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t, la, s, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for *_, w in mine for t in set(w))
        kept = sorted(t for t, n in seen.items() if n >= 3)
        groups = {s: Counter(t for _, s2, w in mine if s2 == s for t in w if seen[t] >= 3) for s in {d[1] for d in mine}}

        def share(c, v=len(kept)):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = sorted(((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in groups if o != s))
            terms = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


@pytest.mark.parametrize("index", [{}, {"shards": 3, "block_chars": 600, "fan_in": 2, "merge_terms": 20}])
def test_op13_brute_force(spark, empty_docs, index):
    from petalframe.llm.op13_source_divergence import divergence

    extra = [(i, f"Ünïcode \x00mixed{'A' * (i % 3)}-case été été_z9 日本 tail{i % 4}", "fr", f"s{i % 5}", 1) for i in range(30)]
    extra += [(60, "...", "fr", "none", 1), (61, "only two of these", "xx", "a", 1), (62, "only two", "xx", "b", 1), (63, None, "xx", None, 1)]
    rows = corpus() + extra
    docs = spark.createDataFrame([(*r, *[None] * 12) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(4)
    got = sorted(tuple(r) for r in divergence(docs, top_terms=7, **index).collect())
    assert got == divergences(rows, 7)
    assert {g[2] for g in got} == {"pair", "term"} and any(g[0] == "xx" and g[4] == 0 for g in got)
    assert divergence(empty_docs, **index).count() == 0


def test_op13_shares_of_large_totals(spark):
    from petalframe.llm.op13_source_divergence import share

    rows = [(10**14 + 7, 3 * 10**14 + 1, 10**6), (0, 0, 3), (5, 5, 1), (10**13, 10**13, 1), (0, 9 * 10**13, 10**9)]
    got = spark.createDataFrame(rows, "c long, n long, v long").select(share("c", "n", "v").alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in rows]
