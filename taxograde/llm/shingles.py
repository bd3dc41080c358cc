"""Word shingles of a batch of texts as 64-bit hashes (numpy, inside tasks).

Words are the lower-cased pieces between ASCII white space; a shingle is ``k``
consecutive words; a text of fewer words (at least one) has a single shingle of
all its words when ``short`` is set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x100000001B3)

#: Characters handled at once in a task: bounds the working arrays.
CHUNK_CHARS = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijective scramble of 64-bit integers."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array):
    """(start, length) row ranges of about CHUNK_CHARS; a long text stands alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = acc = 0
    for i, n in enumerate(size):
        if acc and acc + n > CHUNK_CHARS:
            yield start, i - start
            start, acc = i, 0
        acc += int(n)
    if start < len(size):
        yield start, len(size) - start


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: A fixed random 64-bit value for each byte; white space of ASCII ends a word.
_BYTE = mix(np.arange(256, dtype=np.uint64) * GOLDEN)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text); null texts have none.

    A word's hash is a polynomial of its bytes modulo 2^64, taken from running
    sums over the whole buffer. Windows of the buffer end between words, so a
    text of any length needs little memory.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = off[:-1][np.diff(off) > 0]  # a text begins a word though the byte before it is none of its own
    begins[inner] = ~space[inner]
    start = np.flatnonzero(begins)
    n = np.searchsorted(start, off[1:]) - np.searchsorted(start, off[:-1])
    ends = ~space
    ends[:-1] &= space[1:]
    last = off[1:][np.diff(off) > 0] - 1
    ends[last] = ~space[last]
    end = np.flatnonzero(ends)
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + CHUNK_CHARS)))
        a, z = int(start[lo]), int(end[hi - 1]) + 1
        power, inverse = _powers(z - a)
        sums = np.zeros(z - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:z]] * power[:z - a], out=sums[1:])
        first = start[lo:hi] - a
        out[lo:hi] = (sums[end[lo:hi] - a + 1] - sums[first]) * inverse[first]
        lo = hi
    return mix(out), n.astype(np.int64)


def shingles(texts: pa.Array, k: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of every shingle occurrence, in text order."""
    words, n = word_hashes(texts)
    doc = np.repeat(np.arange(len(n)), n)
    h = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        h = h * _BASE + words[i:i + len(h)]
    inside = doc[:len(h)] == doc[k - 1:] if len(h) else np.zeros(0, bool)
    d, h = doc[:len(h)][inside], mix(h[inside])
    few = np.flatnonzero((n > 0) & (n < k)) if short else []
    if len(few):
        first = np.cumsum(n) - n
        extra = []
        for i in few:
            x = np.zeros(1, np.uint64)
            for w in words[first[i]:first[i] + n[i]]:
                x = x * _BASE + w
            extra.append(mix(x + np.uint64(n[i]))[0])
        d = np.concatenate([d, few])
        h = np.concatenate([h, np.array(extra, np.uint64)])
        order = np.argsort(d, kind="stable")
        d, h = d[order], h[order]
    return d, h


def weighted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with the number of occurrences, sorted by both."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(doc)))


def similarity(a: pa.Array, b: pa.Array, k: int = 5) -> np.ndarray:
    """Weighted Jaccard of the shingle multisets of each pair of texts (0 when both have none)."""
    da, ha = shingles(a, k)
    db, hb = shingles(b, k)
    doc, h = np.concatenate([da, db]), np.concatenate([ha, hb])
    side = np.concatenate([np.zeros(len(da), np.int64), np.ones(len(db), np.int64)])
    order = np.lexsort((h, doc))
    doc, h, side = doc[order], h[order], side[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(len(a))
    nb = np.add.reduceat(side, at)
    na = np.diff(np.append(at, len(doc))) - nb
    low = np.bincount(doc[at], np.minimum(na, nb), len(a))
    high = np.bincount(doc[at], np.maximum(na, nb), len(a))
    return np.divide(low, high, out=np.zeros(len(a)), where=high > 0)
