"""Vectorised word hashing over whole Arrow text batches (numpy, inside tasks).

Words are maximal runs of bytes of one class (0 separates); ASCII letters are
folded to lower case. A word's hash is a polynomial over its bytes modulo 2**64, taken
from one running sum, so no Python object is made per word. Work is done in
blocks of ``BLOCK`` bytes cut between words: memory stays bounded for texts of
any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
U = np.uint64

#: Byte classes. SPACE: words are whatever white space separates.
SPACE = np.ones(256, dtype=np.uint8)
SPACE[[0x20, *range(0x09, 0x0E)]] = 0

#: Letters, digits and all non-ASCII bytes make words, everything else separates.
ALNUM = np.zeros(256, dtype=np.uint8)
ALNUM[ord("0"):ord("9") + 1] = 1
ALNUM[ord("A"):ord("Z") + 1] = 1
ALNUM[ord("a"):ord("z") + 1] = 1
ALNUM[0x80:] = 1

#: As ALNUM, but runs of punctuation are words of their own.
TOKEN = np.where(SPACE == 0, 0, np.where(ALNUM == 1, 1, 2)).astype(np.uint8)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
AS_IS = np.arange(256, dtype=np.uint8)

_powers: list[np.ndarray] = []


def _pw(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK) + 1
        out = []
        for base in (_P, _P_INV):
            a = np.full(size, U(base))
            a[0] = U(1)
            out.append(np.cumprod(a))
        _powers[:] = out
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def text_chunks(col: pa.Array, max_bytes: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices holding about ``max_bytes``
    (a longer text makes its own slice). Nulls count as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def _block_words(data, first, classes, fold):
    """Word starts, ends and hashes of one block; ``first``: bytes that begin a text."""
    kind = classes[data]
    new = np.ones(len(data) + 1, dtype=bool)     # a run begins here, or the one before has ended
    new[1:-1] = kind[1:] != kind[:-1]
    new[first] = True
    at = np.flatnonzero(new)
    s, e = at[:-1], at[1:]
    word = kind[s] > 0
    s, e = s[word], e[word]
    pw, inv = _pw(len(data))
    run = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((fold[data].astype(U) + U(1)) * pw[:len(data)], out=run[1:])
    h = (run[e] - run[s]) * inv[s]
    return s, e, mix(h ^ ((e - s).astype(U) << U(48)))


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = SPACE, fold: np.ndarray = LOWER):
    """(starts, ends, hashes, bounds): every word of the texts, in order;
    text i owns words ``bounds[i]:bounds[i + 1]``."""
    n, pos, parts = len(data), 0, []
    inner = offsets[:-1]
    while pos < n:
        end = min(pos + BLOCK, n)
        if end < n:
            back = np.flatnonzero(classes[data[pos:end]] == 0)
            text = inner[(inner > pos) & (inner <= end)]
            stop = max(pos + int(back[-1]) + 1 if len(back) else 0, int(text[-1]) if len(text) else 0)
            if stop <= pos:              # one word longer than a block: take it whole
                nxt = np.flatnonzero(classes[data[end:]] == 0)
                t = inner[inner > end]
                stop = min(end + int(nxt[0]) if len(nxt) else n, int(t[0]) if len(t) else n)
            end = stop
        here = inner[(inner >= pos) & (inner < end)] - pos
        s, e, h = _block_words(data[pos:end], here, classes, fold)
        parts.append((s + pos, e + pos, h))
        pos = end
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0, dtype=U), np.zeros(len(offsets), dtype=np.int64)
    s, e, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    return s, e, h, np.searchsorted(s, offsets)


_COEF = mix(np.arange(1, 65, dtype=U) * U(0xD6E8FEB86659FD93)) | U(1)


def ngrams(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``n`` words within one text."""
    if len(h) < n:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    out = np.zeros(len(h) - n + 1, dtype=U)
    for j in range(n):
        out += h[j:len(h) - n + 1 + j] * _COEF[j]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(doc[:len(out)] == doc[n - 1:])
    return mix(out[at] + U(n)), at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct ``n``-word shingle hashes of each text; a text of fewer
    words has its whole sequence as one shingle, a text without words none."""
    _, _, h, b = words(data, offsets)
    g, at = ngrams(h, b, n)
    cut = np.searchsorted(at, b)
    out = []
    for i in range(len(b) - 1):
        k = b[i + 1] - b[i]
        if k >= n:
            out.append(np.unique(g[cut[i]:cut[i + 1]]))
        elif k:
            w = h[b[i]:b[i + 1]]
            out.append(mix(np.array([(w * _COEF[:k]).sum(dtype=U) + U(k)])))
        else:
            out.append(np.zeros(0, dtype=U))
    return out
