"""Token ids of a public byte-level BPE vocabulary, memoised by pre-token.

A byte-level BPE never merges across pre-tokens, so the ids of a text are the
ids of its pre-tokens in order. Pre-tokens repeat a great deal: each batch is
cut into pre-tokens, equal ones are found by a 64-bit hash, and the
library only encodes those that this worker has not met. The result equals
``Tokenizer.encode(text, add_special_tokens=False).ids`` with special-token
strings taken as ordinary text (tests compare them).

Where a vocabulary's ids follow the order of its merges (checked when it is
loaded), new pre-tokens are encoded by ``tiktoken`` from the same vocabulary,
at a tenth of the time; any other vocabulary by ``tokenizers``.

The cut follows the published pattern of that vocabulary::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import json
import unicodedata
from functools import cached_property
from itertools import chain
from typing import Sequence

import numpy as np

from petalframe.llm.words import _segment_hashes, _Powers, mix

VOCABULARY = "byte_bpe_50k.json"
#: Distinct pre-tokens one worker keeps (about 150 bytes each); beyond it the memo starts afresh.
MEMO = 250_000

_CHARS = _Powers(0xA0761D6478BD642F)
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            kinds[cp] = _LETTER
        elif c == "N":
            kinds[cp] = _NUMBER
    kinds[list(_WHITE)] = _SPACE
    return kinds


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _contractions(cp: np.ndarray, start: np.ndarray) -> None:
    """The apostrophe forms, in text order: they only match where a pre-token
    may begin, that is at an apostrophe that starts one."""
    at = np.flatnonzero((cp[:-1] == 0x27) & start[:-1])
    after = start[1:]
    for p in at.tolist():
        a = chr(cp[p + 1])
        b = chr(cp[p + 2]) if p + 2 < len(cp) else ""
        size = 2 if a in "stmd" else 3 if a + b in ("re", "ve", "ll") else 0
        # the form ends inside a run of letters: the rest is a pre-token of its own
        if size and (size == 2 or not start[p + 2]):
            after[p] = False
            if p + size < len(start):
                start[p + size] = True


def _byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: itself where it
    prints, else the next unused code point from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """``{token bytes: id}`` of a byte-level BPE file whose merge number i makes
    id 256 + i and whose smaller ids are single bytes; else ``None``."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = _byte_letters()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", ())]
    vocab = model.get("vocab")
    if not merges or not isinstance(vocab, dict):
        return None
    try:
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
    except KeyError:
        return None
    ordered = all(vocab.get("".join(m)) == 256 + i for i, m in enumerate(merges))
    single = {b for b, i in ranks.items() if i < 256} == {bytes([b]) for b in range(256)}
    return ranks if ordered and single and len(ranks) == 256 + len(merges) else None


class MemoTokenizer:
    """One per Python worker and vocabulary file."""

    def __init__(self, path: str | None = None, memo: int = MEMO):
        self.path, self.memo = path, memo
        ranks = merge_ranks(path or vocabulary_path())
        self.piece = None
        if ranks is not None:
            import tiktoken

            self.piece = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.kinds = _classes()
        self._forget()

    @cached_property
    def library(self):
        """The vocabulary in ``tokenizers``, loaded only if it is used."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path or vocabulary_path())
        library.encode_special_tokens = True
        return library

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.pool = np.empty(1 << 16, dtype=np.uint32)
        self.used = 0
        self.first = np.empty(1 << 14, dtype=np.int64)
        self.count = np.empty(1 << 14, dtype=np.int64)

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        if self.piece is None:
            return [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        return [self.piece(p.encode()) for p in pieces]

    def _learn(self, keys: list[int], pieces: list[str]) -> None:
        for i in range(0, len(keys), 8192):
            ids = self._encode_pieces(pieces[i:i + 8192])
            count = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(count.sum()))
            rows, ends = len(self.known), self.used + np.cumsum(count)
            if rows + len(ids) > len(self.first):
                grow = np.empty(rows + len(ids), dtype=np.int64)
                self.first, self.count = np.concatenate([self.first, grow]), np.concatenate([self.count, grow])
            if ends[-1] > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty(int(ends[-1]), dtype=np.uint32)])
            self.pool[self.used:ends[-1]] = flat
            self.first[rows:rows + len(ids)], self.count[rows:rows + len(ids)] = ends - count, count
            self.used = int(ends[-1])
            self.known.update(zip(keys[i:i + 8192], range(rows, rows + len(ids))))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (uint32), and ``len(texts) + 1``
        offsets into them. ``None`` counts as empty."""
        texts = [t or "" for t in texts]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        if not sizes.sum():
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        joined = "\n".join(texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        text_at = np.cumsum(np.r_[0, sizes + 1])
        start = self._starts(cp, text_at, sizes)
        s = np.flatnonzero(start)
        e = np.r_[s[1:], len(cp)]
        own = np.isin(s, text_at[1:] - 1, invert=True)
        s, e = s[own], e[own]
        h = mix(_segment_hashes(lambda a, b: cp[a:b].astype(np.uint64) + np.uint64(1), s, e, _CHARS))
        h ^= mix((e - s).astype(np.uint64))
        keys, rep, inverse = np.unique(h, return_index=True, return_inverse=True)
        listed = keys.tolist()
        new = [i for i, x in enumerate(listed) if x not in self.known]
        if len(self.known) + len(new) > self.memo:
            self._forget()
            new = list(range(len(listed)))
        if new:
            at = rep[new]
            self._learn([listed[i] for i in new], [joined[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())])
        rows = np.fromiter((self.known[x] for x in listed), dtype=np.int64, count=len(listed))[inverse]
        first, count = self.first[rows], self.count[rows]
        ends = np.cumsum(count)
        src = np.arange(ends[-1]) + np.repeat(first - (ends - count), count)
        ids = self.pool[src]
        piece_at = np.r_[0, ends]
        return ids, piece_at[np.searchsorted(s, text_at)]

    def _starts(self, cp: np.ndarray, text_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where pre-tokens start; each text's U+000A behind it starts one too."""
        end = np.zeros(len(cp), dtype=bool)
        end[text_at[1:] - 1] = True
        kind = self.kinds[cp]
        white = kind == _SPACE
        start = np.empty(len(cp), dtype=bool)
        start[0] = True
        start[1:] = kind[1:] != kind[:-1]
        # of white space before a run the last character stands apart; a U+0020 joins the run
        last = np.zeros(len(cp), dtype=bool)
        last[:-1] = white[:-1] & ~end[:-1] & ~white[1:] & ~end[1:]
        start |= last
        start[1:][last[:-1] & (cp[:-1] == 0x20)] = False
        start[text_at[:-1][sizes > 0]] = True
        start[end] = True
        _contractions(cp, start)
        start[end] = True
        return start


_tokenizers: dict[str, MemoTokenizer] = {}


def tokenizer(path: str | None = None) -> MemoTokenizer:
    """This worker's tokenizer for a vocabulary file (default: the public one)."""
    key = path or ""
    if key not in _tokenizers:
        _tokenizers[key] = MemoTokenizer(path)
    return _tokenizers[key]
