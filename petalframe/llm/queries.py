"""Registered queries of the operators over the test tables, and their SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import functions as F

from petalframe.llm.common import ready, table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark, sf_dir):
            ready(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50),
windows AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h FROM starts),
first AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM windows JOIN first USING (h) WHERE doc_id > d),
gone_lists AS (SELECT doc_id, list(i) AS gs FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gs), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gs IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(list_transform(
    list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gs, i)), lambda i: ws[i]), ' ') END) AS kept_sha256
FROM w LEFT JOIN gone_lists USING (doc_id)
"""


@register("op1_substring_dedup", OP1_SQL)
def op1(spark, sf_dir):
    """Whole ``documents``: words left after removing repeated 50-word passages."""
    from petalframe.llm.op1_substring import dedup_substrings

    out = dedup_substrings(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op8_packing")
def op8(spark, sf_dir):
    """Whole ``documents`` as token pieces packed into sequences of up to 1024."""
    from petalframe.llm.op8_packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS w,
  2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS budget FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS closed,
  sum(w) OVER (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM r),
lv AS (SELECT max((budget - closed) / open) FILTER (WHERE (budget - closed) / open * w <= cap) AS level FROM o),
t AS (SELECT source, source_size, budget, CAST(least(cap, coalesce(level * w, cap)) AS DOUBLE) AS target FROM o, lv),
c AS (SELECT d.*, t.source_size, t.target, t.budget,
  sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT doc_id, u, size, budget, copy, (cum - size / 2 + copy * source_size) / target AS due
  FROM c, range(0, 2) k(copy) WHERE size > 0 AND target > 0),
f AS (SELECT *, sum(size) OVER (ORDER BY due, u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM q WHERE due <= 1),
g AS (SELECT doc_id, count(*) AS copies FROM f WHERE total <= budget GROUP BY doc_id)
SELECT c.doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * coalesce(copies, 0) AS BIGINT) AS taken
FROM c LEFT JOIN g USING (doc_id)
"""


@register("op10_mixing", OP10_SQL)
def op10(spark, sf_dir):
    """All ``documents`` mixed to weights 5, 2, 1 and 150 % of all words."""
    from petalframe.llm.op10_mixing import per_row, plan_mix

    plan = plan_mix(table(spark, sf_dir, "documents"))
    rows = plan.withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("repeats").cast("int") - 1)))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * per_row(F.col("copies"), F.col("repeats"), F.col("nth"))).alias("taken"))


@register("op6_token_order")
def op6(spark, sf_dir):
    """All token ids of ``documents`` as 1024-id sequences in training order."""
    from petalframe.llm.op6_token_order import LENGTH, SHARD_SEQUENCES, training_order

    rows = training_order(table(spark, sf_dir, "documents"))
    in_shard = F.pmod("slot", F.lit(SHARD_SEQUENCES))
    return rows.select("slot", "sequence", "n_tokens", F.floor(F.col("slot") / SHARD_SEQUENCES).alias("shard_id"),
                       (in_shard * LENGTH * 2).alias("byte_offset"), F.crc32("payload").alias("payload_crc32"))


@register("op9_secrets")
def op9(spark, sf_dir):
    """Secrets in every whole text of ``documents``."""
    from petalframe.llm.op9_secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@register("op2_toxicity")
def op2(spark, sf_dir):
    """A toxicity score for every whole text of ``documents``."""
    from petalframe.llm.op2_toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@register("op3_near_duplicates")
def op3(spark, sf_dir):
    """Components of ``documents`` linked by 4-word shingle sets at 80 % similarity."""
    from petalframe.llm.op3_minhash import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


@register("op7_html_text")
def op7(spark, sf_dir):
    """Main text of every page of ``pages``."""
    from petalframe.llm.op7_html import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


@register("op4_ann")
def op4(spark, sf_dir):
    """The 10 nearest found for every 100th vector of ``embeddings``."""
    from petalframe.llm.op4_ann import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0, k=10)


OP5_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_dot_product(q.v, c.v) AS BIGINT)) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY q.vec_id, c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op5_inner_products", OP5_SQL)
def op5(spark, sf_dir):
    """The 5 highest inner products for every 50th vector of ``embeddings``."""
    from petalframe.llm.op5_inner import top_products

    return top_products(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part, [
    len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)] AS fails FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
r AS (SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)),
k AS (SELECT unnest(range(1, 6)) AS k),
o AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM r GROUP BY part, fails),
s AS (
  SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, k.k AS step, o[k.k] AS own,
    n, good, toxic, fails[o[k.k]] AS hit,
    len(list_filter(o[1:k.k - 1], lambda i: fails[i])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) = 1 AS single
  FROM g, o, k),
t AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND single THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM t
"""


@register("op11_filter_audit", OP11_SQL)
def op11(spark, sf_dir):
    """Five filters over all ``documents`` in every order, per language."""
    from petalframe.llm.op11_filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_two_fit_packing")
def op12(spark, sf_dir):
    """All ``documents`` packed into as few sequences of 2048 ids as best-two-fit finds."""
    from petalframe.llm.op12_two_fit import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, id, unnest(ts) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cg AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
pg AS (
  SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS HUGEINT) AS p
  FROM cg JOIN vs USING (lang)),
cl AS (SELECT lang, term, sum(n) AS n FROM cg GROUP BY lang, term),
pl AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS HUGEINT) AS q FROM cl JOIN vs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM pg a JOIN pg b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT pg.lang, source, 'term' AS part, pg.term AS item, (p - q) * (p - q) // q AS value
  FROM pg JOIN pl ON pg.lang = pl.lang AND pg.term = pl.term WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


@register("op13_source_divergence", OP13_SQL)
def op13(spark, sf_dir):
    """How the term shares of every source of ``documents`` differ from the others of its language."""
    from petalframe.llm.op13_source_divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))
