"""Words of whole texts by classes of UTF-8 bytes, as numpy arrays.

A word is a maximal run of bytes of one class; every byte of a character beyond
ASCII belongs to a word.  Texts are read from Arrow buffers as they are, so no
Python strings are made.  A word's 64-bit hash is a polynomial of its bytes,
taken from prefix sums modulo 2**64 and finalised.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shardwise.llm.textvec import P, P_INVERSE, U, mix


class ByteWords(NamedTuple):
    hashes: np.ndarray  # uint64, the words of all texts one after the other
    bounds: np.ndarray  # int64, text i has the words bounds[i]:bounds[i + 1]


def byte_table(separators: bytes, fold: bool) -> np.ndarray:
    """Code of each byte: 0 for a separator, else 1 + the byte, A-Z as a-z with ``fold``."""
    codes = np.arange(1, 257, dtype=np.uint16)
    if fold:
        codes[65:91] += 32
    codes[list(separators)] = 0
    return codes


BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: words between blanks as they are, and with A-Z lower-cased
PLAIN, FOLDED = byte_table(BLANKS, False), byte_table(BLANKS, True)
#: letters, digits and all beyond ASCII, A-Z lower-cased
TERMS = byte_table(bytes(i for i in range(128) if not chr(i).isalnum()), True)


def binary(texts: pa.Array) -> pa.Array:
    """A string array without nulls (they become empty), as large binary."""
    return pc.fill_null(texts, "").cast(pa.large_string()).cast(pa.large_binary())


def slices(texts: pa.Array, most: int):
    """(start, end) of ranges of about ``most`` bytes; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, end
        at, before = end, int(ends[end - 1])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    t = np.full(n, base, dtype=U)
    t[0] = U(1)
    return np.multiply.accumulate(t)


_kept: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i < n; tables of usual size are kept."""
    if _kept and len(_kept[0]) >= n:
        return _kept[0], _kept[1]
    pair = [_powers(P, max(n, 1 << 20)), _powers(P_INVERSE, max(n, 1 << 20))]
    if n <= 1 << 20:
        _kept[:] = pair
    return pair[0], pair[1]


def words(texts: pa.Array, table: np.ndarray) -> ByteWords:
    """Hashes of the words of a large binary array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    if lo == hi:
        return ByteWords(np.empty(0, U), np.zeros(len(texts) + 1, np.int64))
    codes = table[np.frombuffer(texts.buffers()[2], dtype=np.uint8)[lo:hi]]
    n = hi - lo
    inside = codes > 0
    cut = np.zeros(n + 1, dtype=bool)  # a text starts here
    cut[offsets - lo] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    first, after = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum((codes.astype(U) + U(0x51ED270B)) * power[:n], out=sums[1:])
    hashes = mix((sums[after] - sums[first]) * inverse[first] + (after - first).astype(U))
    return ByteWords(hashes, np.searchsorted(first, offsets - lo).astype(np.int64))


def shingle_sets(w: ByteWords, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``n`` consecutive words of each text, sorted, and
    their bounds; a text of fewer words (but one at least) has one of them all."""
    total, count = len(w.hashes), np.diff(w.bounds)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(count)), size)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + w.bounds[:-1][doc]
    out = np.full(len(doc), U(0x2545F4914F6CDD1D), dtype=U)
    width = np.minimum(count, n)[doc]
    for k in range(n):
        here = width > k
        step = mix(out * P + w.hashes[np.minimum(place + k, max(total - 1, 0))]) if total else out
        out = np.where(here, step, out)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(count) + 1)).astype(np.int64)
