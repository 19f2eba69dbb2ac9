"""Word and shingle hashes of whole texts, vectorised over the bytes of a batch.

A word is a maximal run of word bytes inside one text. Its 64-bit hash is a
polynomial over random byte codes, taken from prefix sums modulo 2**64, so one
pass of array operations hashes every word of a batch without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

U = np.uint64
#: Bytes handled at once; bounds the temporary arrays to about 20 MB.
CHUNK = 1 << 18


def _byte_classes(space: bool) -> np.ndarray:
    is_word = np.ones(256, bool)
    if space:  # words are runs of anything but ASCII white space
        is_word[[9, 10, 11, 12, 13, 32]] = False
    else:  # words are runs of digits, letters and non-ASCII
        is_word[:128] = False
        is_word[48:58] = is_word[65:91] = is_word[97:123] = True
    return is_word


SPACED, ALNUM = _byte_classes(True), _byte_classes(False)


@cache
def byte_codes(fold: bool = True) -> np.ndarray:
    """A random odd number for each byte; fold: A-Z count as a-z."""
    codes = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
    if fold:
        codes[65:91] = codes[97:123]
    return codes


_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_MUL, _INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


@cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers_of(2 * CHUNK)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, at least."""
    return _usual_powers() if n <= 2 * CHUNK else _powers_of(n)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _piece(data: np.ndarray, inner: np.ndarray, is_word: np.ndarray):
    """Starts, ends (exclusive) and hashes of the words of data; inner: where texts begin."""
    n = len(data)
    m = is_word[data]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = m[inner]
    last[inner - 1] = m[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, inverse = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_codes()[data] * up[:n], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * inverse[starts])


def word_groups(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of texts in order: (first row, end row, words in each, their hashes)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[end])
        if hi - lo <= 2 * CHUNK:
            starts, _, hashes = _piece(data[lo:hi], offsets[row:end] - lo, is_word)
            edges = np.searchsorted(starts, offsets[row : end + 1] - lo)
            yield row, end, np.diff(edges), hashes
        else:  # one long text: cut where no word is
            parts, at = [], lo
            while at < hi:
                stop = min(hi, at + CHUNK)
                while stop < hi and is_word[data[stop]]:
                    gap = np.flatnonzero(~is_word[data[stop : stop + CHUNK]])
                    stop = min(hi, stop + (int(gap[0]) if len(gap) else CHUNK))
                parts.append(_piece(data[at:stop], np.zeros(0, np.int64), is_word)[2])
                at = stop
            hashes = np.concatenate(parts)
            yield row, end, np.array([len(hashes)]), hashes
        row = end


_STEPS = [[pow(base | 1, j + 1, 1 << 64) for j in range(32)] for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(words: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """Hash of each k consecutive words; the families are independent of each other."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += words[j : j + n] * U(_STEPS[family][j])
    return mix(h + U(k))


def distinct_shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles; fewer words make one."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(words, min(k, len(words))))
