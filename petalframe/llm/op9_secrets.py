"""Secret scan: fixed patterns, and a token-efficiency test for the rest.

Base patterns find assignments to secret names, access key ids and long
hexadecimal runs. The method adds runs of key characters that a public BPE
vocabulary spends many tokens on: text costs one token for several characters,
a random string one for fewer than ``MAX_RATIO``. Known digests (hexadecimal
of a usual digest length), UUIDs, plain numbers and strings without digits are
identifiers, not secrets, and excluded.

Every text is scanned whole, row by row, without a shuffle. Positions are code
points, ends exclusive. A null or empty text has no spans; repeated rows are
answered one by one; a null ``doc_id`` is carried as null; ``find_secrets``
ignores other columns, ``redact_secrets`` carries them unchanged.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from petalframe.llm.common import id_and_text, released

#: The base patterns and the shortest lengths that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
NAMES = ("password", "passwd", "secret", "token", "api")
ASSIGN_MIN, ACCESS_MIN = 8, 16
KINDS = ("assign", "access", "hex", "rare")

#: A run of key characters; access and hex matches lie inside one.
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
PART = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
MAX_RATIO = 2.1
VOCABULARY = "byte_bpe_50k.tiktoken"
MASK = "[SECRET]"

_encodings: dict = {}


def encoding(path: str | None = None):
    """This worker's tiktoken encoding for a vocabulary file of ranks."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def is_rare(s: str, enc, max_ratio: float = MAX_RATIO) -> bool:
    """Whether a run of key characters looks random to the vocabulary."""
    body = s.strip("=-_/+")
    if len(body) < 20 or not re.search(r"[0-9]", body) or not re.search(r"[A-Za-z]", body):
        return False
    if UUID.match(body) or DIGEST.match(body) and len(body) in DIGEST_LENGTHS:
        return False
    # words, numbers or dates joined by signs are names, not keys
    if max(map(len, re.split(r"[-_/+=]", body))) < 12:
        return False
    return len(body) / len(enc.encode_ordinary(body)) < max_ratio


def scan(text: str | None, enc, max_ratio: float = MAX_RATIO) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """``(base spans, added spans)`` of a text as (start, end, kind), each sorted."""
    if not text:
        return [], []
    base = []
    lowered = text.lower()
    if any(n in lowered for n in NAMES):
        base += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    runs = [(m.start(), m.end(), m[0]) for m in RUN.finditer(text)]
    for at, _, run in runs:
        if "AKIA" in run:
            base += [(at + m.start(), at + m.end(), "access") for m in ACCESS.finditer(run) if len(m[0]) >= ACCESS_MIN]
        if len(run) >= 32:
            base += [(at + m.start(), at + m.end(), "hex") for m in HEX.finditer(run)]
    base.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    added = []
    # a part overlaps a base span if one that starts before its end reaches beyond its start
    starts, reach = [s for s, *_ in base], list(accumulate((e for _, e, _ in base), max))
    for at, _, run in runs:
        for m in PART.finditer(run):
            s, e = at + m.start(), at + m.end()
            before = bisect_left(starts, e)
            if not (before and reach[before - 1] > s) and is_rare(m[0], enc, max_ratio):
                added.append((s, e, "rare"))
    return base, added


def _told(spans) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def find_secrets(docs: DataFrame, vocabulary: str | None = None, max_ratio: float = MAX_RATIO,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_rare,
    base_sha256`` (of the base spans as ``kind:start:end``, comma-joined),
    ``spans`` (all spans, likewise)."""

    def run(batches):
        enc = encoding(vocabulary)
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                base, added = scan(text, enc, max_ratio)
                n = [sum(k == kind for *_, k in base + added) for kind in KINDS]
                spans = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))
                out.append((*n, hashlib.sha256(_told(base).encode()).hexdigest(), _told(spans)))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_rare", "base_sha256", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_rare bigint, base_sha256 string, spans string")


def redact(text: str | None, enc, max_ratio: float = MAX_RATIO, mask: str = MASK) -> str | None:
    """The text with every span (overlapping ones together) replaced by ``mask``."""
    base, added = scan(text, enc, max_ratio)
    if not base and not added:
        return text
    out, at = [], 0
    for s, e, _ in sorted(base + added):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, vocabulary: str | None = None, max_ratio: float = MAX_RATIO, mask: str = MASK,
                   text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns, secrets in the text masked; ``count_col`` (if the
    input has it) becomes the new text's code points where a text changed."""
    i = docs.columns.index(text_col)
    k = docs.columns.index(count_col) if count_col in docs.columns else None

    def run(batches):
        enc = encoding(vocabulary)
        for b in released(batches):
            old = b.column(i).to_pylist()
            new = [redact(t, enc, max_ratio, mask) for t in old]
            if new == old:
                yield b
                continue
            cols = b.columns
            cols[i] = pa.array(new, b.schema.field(i).type)
            if k is not None:
                n = [m if t == u else len(u) for m, t, u in zip(cols[k].to_pylist(), old, new)]
                cols[k] = pa.array(n, b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
