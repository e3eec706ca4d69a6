"""Words of whole texts as numpy arrays of 64-bit hashes.

A word is a maximal run of ASCII letters and digits and of characters from
U+00C0 on (and the letters U+00AA, U+00B5, U+00BA), without general and CJK
punctuation; texts are lower-cased first.  Hashing works on all characters of
a slice of texts at once: prefix sums of ``code * P**i`` modulo 2**64 give each
word's polynomial hash from its two ends.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
P = U(0x9E3779B97F4A7C15)
P_INVERSE = U(pow(int(P), -1, 1 << 64))
SLICE_CHARS = 500_000  # characters handled at once in a task

_powers: tuple[np.ndarray, np.ndarray] | None = None


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, of all texts one after the other
    bounds: np.ndarray  # int64, text i has the words bounds[i]:bounds[i + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE_CHARS + 4096)
        tables = []
        for base in (P, P_INVERSE):
            t = np.full(size, base, dtype=U)
            t[0] = U(1)
            tables.append(np.multiply.accumulate(t))
        if size > 2 * SLICE_CHARS:
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


_ascii = np.zeros(0x3100, dtype=bool)
for _lo, _hi in ((48, 58), (97, 123), (65, 91), (0xAA, 0xAB), (0xB5, 0xB6), (0xBA, 0xBB), (0xC0, 0x2000), (0x2070, 0x3000), (0x3040, 0x3100)):
    _ascii[_lo:_hi] = True


def is_word_char(codes: np.ndarray) -> np.ndarray:
    return _ascii[np.minimum(codes, 0x30FF)]


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each followed by one blank, and
    the start of each text in that array (one more entry: the total)."""
    low = [t.lower() for t in texts]
    joined = " ".join(low) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in low], out=starts[1:])
    return codes, starts


def words(texts: list[str]) -> Words:
    if not texts:
        return Words(np.empty(0, U), np.zeros(1, np.int64))
    codes, starts = codes_of(texts)
    inside = is_word_char(codes)
    edge = np.diff(inside.astype(np.int8), prepend=0)
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=U)
    np.cumsum((codes.astype(U) + U(0x51ED270B)) * power[: len(codes)], out=sums[1:])
    hashes = mix((sums[after] - sums[first]) * inverse[first] + (after - first).astype(U))
    return Words(hashes, np.searchsorted(first, starts).astype(np.int64))


def shingles(w: Words, n: int) -> Words:
    """Hashes of the ``n`` consecutive words at each place; a text of fewer
    words (but at least one) has one shingle of all its words."""
    total = len(w.hashes)
    count = np.diff(w.bounds)
    out = np.zeros(max(total, 1), dtype=U)
    for k in range(n):
        out = out * P
        out[: total - k] += w.hashes[k:total] if k < total else U(0)
    sizes = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    take = np.repeat(w.bounds[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
    res = mix(out[take]) if len(take) else np.empty(0, U)
    for i in np.flatnonzero((count > 0) & (count < n)):  # fewer words than n
        h = U(0)
        with np.errstate(over="ignore"):
            for x in w.hashes[w.bounds[i] : w.bounds[i + 1]]:
                h = h * P + x
            res[bounds[i]] = mix(np.array([h * P + U(int(count[i]))], dtype=U))[0]
    return Words(res, bounds)
