"""Toxicity by weak supervision.

Voters look at a text: each holds part of a lexicon or a pattern and fires or
stays silent. The lexicon is a short public list of insults plus terms (whole
words and word beginnings) that labelled training rows tie to toxic texts. A
generative label model explains the votes over *all* documents by a hidden
class: per voter a firing rate in either class, found by expectation
maximisation, and per pair of voters the correlation that remains inside a
class, which discounts voters that say the same. On training rows the given
label is one more voter, with an accuracy of its own. A linear classifier over
terms, densities and votes is then trained on the posterior labels and scores
every text.

Labels are read only where crc32 of the id (as text) modulo 3 is not 1; a
score never sees labels, ids, language or source. The classifier and the
lexicon are fitted on a sample of labelled rows bounded by ``SAMPLE`` rows per
class, picked by a hash of the id; the votes are counted over all documents
(at most 2**voters different patterns reach the driver). Only bounded objects
are broadcast: the sampled ids, the lexicon and the weights.

Defined cases: null and empty texts are scored like any text without votes;
without usable labels the public list alone votes and the classifier falls
back to the label model's own weights; repeated rows are scored one by one;
repeated or contradicting labels of a document take part each; a null
``doc_id`` is scored, never learned from and never held out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import id_and_text, released, small_side, write_stage
from petalframe.llm.words import small_batches

#: A public list of everyday insults.
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "clown", "pathetic", "worthless", "disgusting",
           "imbecile", "dumb", "garbage", "bastard", "jerk", "fool")
#: Labelled rows per class that lexicon and classifier are fitted on, at most.
SAMPLE = 10_000
TERMS, LEXICON_VOTERS = 400, 12
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Least likelihood-ratio statistic of a term (one degree of freedom): chance
#: alone reaches it about once in 10**6 terms. And the least ratio of its
#: shares of toxic and clean texts: a voter names toxic texts, not a style.
MIN_G, MIN_ODDS = 24.0, 10.0
THRESHOLD = 0.7

_LETTERS = re.compile(r"[^\W\d_]+")
_YOU = re.compile(r"\b(?:you|your|du|dich|tu|toi|vous|usted|eres)\b")
PATTERNS = ("two terms", "three terms", "five hits", "dense", "addressed", "shouting", "marks")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def terms_of(token: str) -> list[str]:
    """Whole words (``=word``) and word beginnings (``beginning-``) of one token."""
    out = []
    for w in _LETTERS.findall(token):
        out.append("=" + w)
        out += [w[:k] + "-" for k in PREFIXES if len(w) >= k]
    return out


#: Tokens whose terms a task remembers (about 200 bytes each); beyond it the memo starts afresh.
MEMO = 100_000


@dataclass
class Lexicon:
    """Terms with their voter; remembers tokens already looked up."""

    terms: dict[str, int]
    voter: np.ndarray
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def lookup(self, token: str) -> tuple[int, ...]:
        hit = self.memo.get(token)
        if hit is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            hit = self.memo[token] = tuple({self.terms[t] for t in terms_of(token) if t in self.terms})
        return hit

    def __getstate__(self):
        return {"terms": self.terms, "voter": self.voter, "memo": {}}

    @property
    def n_voters(self) -> int:
        return LEXICON_VOTERS + len(PATTERNS)

    def features(self, text: str | None) -> tuple[list[int], int, float, float]:
        """``(term numbers, votes as bits, log hits, density)``."""
        if not text:
            return [], 0, 0.0, 0.0
        low = text.lower()
        counts = Counter(low.split())
        found: set[int] = set()
        hits = 0
        for token, n in counts.items():
            ids = self.lookup(token)
            if ids:
                found.update(ids)
                hits += n
        votes = 0
        for t in found:
            votes |= 1 << int(self.voter[t])
        total = sum(counts.values())
        density = hits / max(total, 1)
        letters = sum(map(str.isalpha, text)) if found else 0
        shouting = letters > 20 and sum(map(str.isupper, text)) > 0.5 * letters
        fired = (len(found) >= 2, len(found) >= 3, hits >= 5, density >= 0.01, bool(found) and bool(_YOU.search(low)),
                 shouting, bool(found) and ("!!" in low or "?!" in low))
        for k, f in enumerate(fired):
            votes |= int(f) << (LEXICON_VOTERS + k)
        return sorted(found), votes, float(np.log1p(hits)), density


def training_rows(labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                  label_col: str = "toxic") -> tuple[DataFrame, dict[int, int]]:
    """At most about ``sample`` (document, label) pairs per class of the usable
    labels, and how many there are per class. Equal label rows count once, so one
    id's labels, however often repeated, are one pair a class."""
    rows = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct())
    n = {0: 0, 1: 0} | {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1_000_000))
    share = F.when(F.col("y") == 1, F.lit(sample / max(n[1], 1))).otherwise(F.lit(sample / max(n[0], 1)))
    return rows.where(part < share * 1_000_000), n


def mine_lexicon(train: DataFrame, max_terms: int = TERMS) -> Lexicon:
    """The public list, then terms far commoner in toxic than in clean training texts, strongest first."""

    def count(batches):
        for b in batches:
            texts, ys = b.column("text").to_pylist(), b.column("y").to_pylist()
            for i, k in small_batches(texts):
                seen: dict[str, list[int]] = {}
                for text, y in zip(texts[i:k], ys[i:k]):
                    for t in {t for token in set((text or "").lower().split()) for t in terms_of(token)}:
                        seen.setdefault(t, [0, 0])[y] += 1
                cols = [pa.array([v[c] for v in seen.values()], pa.int64()) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), *cols], ["term", "clean", "toxic"])

    n = {0: 0, 1: 0} | {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = (train.mapInArrow(count, "term string, clean bigint, toxic bigint").groupBy("term")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 3"))
    share = n[1] / max(1, n[0] + n[1])
    every = F.col("toxic") + F.col("clean")
    g = 2 * (F.col("toxic") * F.log(F.col("toxic") / (every * share))
             + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (every * (1 - share)))).otherwise(0.0))
    # among terms that say the same, whole words and then the longest beginnings come first
    odds = F.col("toxic") / (F.col("clean") + 1) * (n[0] / max(1, n[1]))
    best = (counts.where(odds >= MIN_ODDS).withColumn("g", F.round(g, 6)).where(F.col("g") >= MIN_G)
            .orderBy(F.desc("g"), ~F.col("term").startswith("="), F.desc(F.length("term")), "term").limit(20 * max_terms).collect()) if share else []
    terms = ["=" + w for w in INSULTS]
    for r in best:
        # a term above or below a kept one on the same beginning adds nothing
        stem = r["term"].strip("=-")
        if len(terms) < max_terms and not any(_nested(stem, r["term"][0] == "=", t) for t in terms):
            terms.append(r["term"])
    return Lexicon({t: i for i, t in enumerate(terms)}, np.arange(len(terms)) % LEXICON_VOTERS)


def _nested(stem: str, whole: bool, kept: str) -> bool:
    other = kept.strip("=-")
    if whole and kept[0] == "=":
        return stem == other
    return stem.startswith(other) if kept[0] != "=" else other.startswith(stem)


def vote_counts(docs: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns over all documents: ``(bits, number of documents)``."""

    def run(batches):
        for b in released(batches):
            c = Counter(lexicon.features(t)[1] for t in b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(c.values(), pa.int64())], ["votes", "n"])

    rows = docs.select("text").mapInArrow(run, "votes bigint, n bigint").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    bits = np.array([[(r["votes"] >> k) & 1 for k in range(lexicon.n_voters)] for r in rows], dtype=float)
    return bits.reshape(len(rows), lexicon.n_voters), np.array([r["n"] for r in rows], dtype=float)


@dataclass
class LabelModel:
    """Hidden class, firing rates ``rate[class, voter]``, and ``weight`` per
    voter: 1 over 1 plus its positive correlations inside the classes."""

    prior: float
    rate: np.ndarray
    weight: np.ndarray

    def log_odds(self, bits: np.ndarray) -> np.ndarray:
        fired = np.log(self.rate[1] / self.rate[0])
        silent = np.log((1 - self.rate[1]) / (1 - self.rate[0]))
        return np.log(self.prior / (1 - self.prior)) + bits @ (self.weight * (fired - silent)) + (self.weight * silent).sum()

    @classmethod
    def fit(cls, bits: np.ndarray, n: np.ndarray, prior: float, rate: np.ndarray, steps: int = 30) -> "LabelModel":
        m = cls(prior, rate.copy(), np.ones(bits.shape[1]))
        for step in range(steps if len(n) else 0):
            post = sigmoid(m.log_odds(bits))
            w = np.stack([(1 - post) * n, post * n])
            total = w.sum(axis=1)
            m.prior = float(np.clip(total[1] / total.sum(), 1e-4, 0.9))
            # each class starts from pseudo-counts around the first rates, so that a rare class keeps its meaning
            m.rate = np.clip((w @ bits + 20 * rate) / (total[:, None] + 20), 1e-4, 1 - 1e-4)
            if step % 5 == 4:
                corr = np.zeros((bits.shape[1],) * 2)
                for c in (0, 1):
                    d = bits - m.rate[c]
                    cov = (d * w[c][:, None]).T @ d / max(total[c], 1e-9)
                    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                    corr += np.clip(cov / sd[:, None] / sd[None, :], 0, 1) / 2
                np.fill_diagonal(corr, 0)
                m.weight = 1 / (1 + corr.sum(axis=1))
        return m


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(x: np.ndarray, soft: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression on soft labels (last column: the constant), by Newton steps."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ beta)
        grad = x.T @ (weight * (soft - p)) - penalty * beta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hess, grad)
        beta += move * min(1.0, 4.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return beta


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    label_model: LabelModel
    term: np.ndarray
    vote: np.ndarray
    hits: float
    density: float
    constant: float

    def score(self, text: str | None) -> float:
        found, votes, hits, density = self.lexicon.features(text)
        z = self.constant + self.hits * hits + self.density * density + float(self.term[found].sum())
        for k, w in enumerate(self.vote):
            if votes >> k & 1:
                z += float(w)
        return float(sigmoid(z))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", label_id_col: str = "doc_id") -> ToxicityModel:
    docs = id_and_text(docs, id_col, text_col)
    ids, n_labelled = training_rows(labels, sample, label_id_col, label_col)
    ids, _ = small_side(ids, "toxic-ids")
    # one text of each pair, the same at every run: bounded by ``sample``, whatever repeats
    train = docs.join(ids, "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "y")
    train, _ = write_stage(train, "toxic-train")
    usable = min(n_labelled.values()) > 0
    lexicon = mine_lexicon(train)
    v, t = lexicon.n_voters, len(lexicon.terms)

    def run(batches):
        for b in batches:
            rows = [lexicon.features(x) for x in b.column("text").to_pylist()]
            cols = list(zip(*rows)) or [()] * 4
            kinds = (pa.list_(pa.int32()), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("y"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["y", "terms", "votes", "hits", "density"])

    found = Counter()
    if usable:
        # equal feature rows count once
        for r in train.mapInArrow(run, "y int, terms array<int>, votes bigint, hits double, density double").collect():
            found[r["y"], tuple(r["terms"]), r["votes"], r["hits"], round(r["density"], 4)] += 1
    y = np.array([k[0] for k in found], dtype=int)
    seen = np.array(list(found.values()), dtype=float)
    bits = np.array([[k[2] >> j & 1 for j in range(v)] for k in found], dtype=float).reshape(len(found), v)
    rate = np.full((2, v), 0.01)
    rate[1] = 0.3
    prior = 0.1
    if usable and len(found):
        for c in (0, 1):
            w = seen * (y == c)
            rate[c] = np.clip((w @ bits + 0.5) / (w.sum() + 1), 1e-3, 1 - 1e-3)
        prior = float(np.clip(n_labelled[1] / sum(n_labelled.values()), 1e-3, 0.9))
    model = LabelModel.fit(*vote_counts(docs, lexicon), prior, rate)
    fired = np.log(model.rate[1] / model.rate[0])
    silent = np.log((1 - model.rate[1]) / (1 - model.rate[0]))
    if not (usable and len(found)):
        const = np.log(model.prior / (1 - model.prior)) + float((model.weight * silent).sum())
        return ToxicityModel(lexicon, model, np.zeros(t), model.weight * (fired - silent), 0.0, 0.0, float(const))

    # the sample is by class: back to the share each class has among the labels
    share = np.array([n_labelled[c] / max(1.0, seen[y == c].sum()) for c in (0, 1)])
    weight = seen * share[y]
    z, right = model.log_odds(bits), np.array([0.95, 0.95])
    for _ in range(5):  # the given label as a voter: how often it names the class
        post = sigmoid(z + np.where(y == 1, np.log(right[1] / (1 - right[0])), np.log((1 - right[1]) / right[0])))
        hit = np.array([(weight * (1 - post))[y == 0].sum(), (weight * post)[y == 1].sum()])
        all_ = np.array([(weight * (1 - post)).sum(), (weight * post).sum()])
        right = np.clip((hit + 95) / (all_ + 100), 0.8, 0.995)
    x = np.zeros((len(found), t + v + 3))
    for i, k in enumerate(found):
        x[i, list(k[1])] = 1
        x[i, t + v:] = k[3], k[4], 1
    x[:, t:t + v] = bits
    beta = logistic(x, post, weight / share.min() if share.min() > 0 else weight)
    return ToxicityModel(lexicon, model, beta[:t], beta[t:t + v], float(beta[-3]), float(beta[-2]), float(beta[-1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([model.score(t) for t in b.column("text").to_pylist()], pa.float64())],
                                             ["doc_id", "score"])

    scored = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """All columns of the rows that score below ``threshold``."""
    i = docs.columns.index(text_col)

    def run(batches):
        for b in released(batches):
            yield b.filter(pa.array([model.score(t) < threshold for t in b.column(i).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
