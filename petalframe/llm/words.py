"""Words and word n-grams of whole texts as 64-bit hashes, in numpy.

A word is a maximal run of code points other than U+0020 and U+0009-U+000D.
Those six are single bytes in UTF-8 and never part of a longer sequence, so
words are found on the bytes. Nothing here is quadratic in a text's length,
and temporaries stay within ``SLICE`` elements whatever that length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U64 = np.uint64
SLICE = 1 << 17

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


def _odd_inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class _Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, _odd_inverse(base)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            ones = np.ones(size, dtype=U64)
            for name, x in (("up", self.base), ("down", self.inverse)):
                a = ones * U64(x)
                a[0] = U64(1)
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _WORDS2 = (_Powers(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _segment_hashes(values, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hash of ``values(a, b)[start - a:end - a]`` for ascending,
    possibly overlapping segments, a slice of them at a time."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        k = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        a, b = int(starts[i]), int(ends[k - 1])
        up, down = powers.upto(b - a + 1)
        s = np.zeros(b - a + 1, dtype=U64)
        np.cumsum(values(a, b) * up[:b - a], out=s[1:])
        out[i:k] = (s[ends[i:k] - a] - s[starts[i:k] - a]) * down[starts[i:k] - a]
        i = k
    return out


class Words:
    """The words of a batch of texts (``None`` counts as empty).

    ``starts`` / ``ends``: byte positions in ``data``; ``offsets[i]`` to
    ``offsets[i + 1]``: the words of text i; ``hashes``: one per word.
    """

    def __init__(self, texts: Iterable[str | None], lower: bool = False):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b" ".join(raw) + b" "
        buf = np.frombuffer(self.data, dtype=np.uint8)
        at = np.cumsum([0] + [len(r) + 1 for r in raw])
        gap = np.empty(len(buf) + 1, dtype=bool)
        gap[0], gap[1:] = True, _SEPARATOR[buf]
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.offsets = np.searchsorted(self.starts, at)
        table = _BYTE_LOWER if lower else _BYTE
        self.hashes = mix(_segment_hashes(lambda a, b: table[buf[a:b]], self.starts, self.ends, _BYTES))

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i]:self.offsets[i + 1]]

    def kept_bytes(self, i: int, keep: np.ndarray) -> bytes:
        """Words of text i where ``keep``, joined by one space."""
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        s, e = self.starts[a:b][keep], self.ends[a:b][keep]
        return b" ".join(self.data[x:y] for x, y in zip(s.tolist(), e.tolist()))


def grams(hashes: np.ndarray, size: int, at: np.ndarray | None = None, second: bool = False) -> np.ndarray:
    """Hash of the ``size`` values from each position (all, or ascending ``at``)."""
    if at is None:
        at = np.arange(max(0, len(hashes) - size + 1))
    if not len(at):
        return np.empty(0, dtype=U64)
    return mix(_segment_hashes(lambda a, b: hashes[a:b], at, at + size, _WORDS2 if second else _WORDS))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


def small_batches(texts: list, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters (one longer text stands alone)."""
    i = n = 0
    for k, t in enumerate(texts):
        m = 0 if t is None else len(t)
        if k > i and n + m > limit:
            yield i, k
            i, n = k, 0
        n += m
    if i < len(texts):
        yield i, len(texts)
