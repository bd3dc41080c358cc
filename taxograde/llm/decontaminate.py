"""Operator 7: benchmark passages inside documents by size-partitioned MinHash.

Test items are partitioned by size: class c holds the items of 2^(c-1)+1 .. 2^c
distinct five-word shingles. For each class, a document is a row of windows of
3 * 2^c shingles that advance by 2^c, so that the passage of an item with room
for insertions lies inside one window. A window and an item of the class differ
in size by a bounded factor, so the containment threshold t turns into a Jaccard
threshold t / (u / q + 1 - t) of the class (u: window, q: item), and ``HASHES``
minhash coordinates are banded with the most rows that still keep the chance of
a miss at that threshold below ``MISS``. The minimum of a window is the minimum
of its three blocks, so a shingle is hashed once per coordinate for all classes.
Candidates are verified by exact containment: the share of the item's distinct
shingles that the whole document holds. An item of fewer than five words is one
shingle of all its words; it is contained where they stand in a row, which is looked
up for every place of the document.

The items are the stated query set. They pass through the driver in blocks of at
most ``BLOCK_CHARS`` characters (measured by Spark first), each block broadcast
as an index and matched against all documents in a pass of its own, so that
neither the driver nor a task ever holds more than a block.

Nulls and edges: null or empty texts on either side match nothing. Rows of one
doc_id or item_id are taken one by one; equal result rows appear once per pair
of rows (equal items are indexed once and counted). Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import functools
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import prepared, table

THRESHOLD = 0.8
SHINGLE = 5
HASHES = 64
MISS = 1e-3
BLOCK_CHARS = 16_000_000
RESULT = "doc_id long, item_id long, n_shared long, n_item long, containment double"
_FILTER_BITS = 20
_SLICE = 1 << 15  # shingles whose minima are taken at once


def _factors() -> np.ndarray:
    return (S.mix(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def size_class(n: np.ndarray) -> np.ndarray:
    """Class of an item of n shingles: the smallest c with n <= 2^c."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def rows_per_band(c: int, threshold: float = THRESHOLD) -> int:
    """The most rows that keep a miss at the class's Jaccard threshold under MISS."""
    smallest = 2 ** (c - 1) + 1 if c else 1
    jaccard = threshold / (3 * 2 ** c / smallest + 1 - threshold)
    best = 1
    for rows in range(1, 5):
        if (1 - jaccard ** rows) ** (HASHES // rows) < MISS:
            best = rows
    return best


def _bands(minima: np.ndarray, rows: int) -> np.ndarray:
    """(windows, HASHES) minima -> (windows, HASHES // rows) keys that depend on the band."""
    n = HASHES // rows
    part = minima[:, :n * rows].reshape(len(minima), n, rows).astype(np.uint64)
    key = np.broadcast_to(S.mix(np.arange(n, dtype=np.uint64)), part.shape[:2]).copy()
    for i in range(rows):
        key = S.mix(key ^ part[:, :, i])
    return key


def runs_of_words(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every ``k`` words in a row."""
    doc = np.repeat(np.arange(len(counts)), counts)
    h = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        h = S.mix(h ^ words[i:i + len(h)])
    ok = doc[:len(h)] == doc[k - 1:] if len(h) else np.zeros(0, bool)
    return doc[:len(h)][ok], h[ok]


def build_index(ids: list, texts: list, times: list | None = None) -> dict:
    """Index of one block of items: by class the sorted band keys and their items; short items by length."""
    arr = pa.array(texts, pa.string())
    words, counts = S.word_hashes(arr)
    short = {}
    for k in range(1, SHINGLE):
        of = np.flatnonzero(counts == k)
        if len(of):
            doc, h = runs_of_words(words, counts, k)
            keys = h[np.isin(doc, of)]  # in the order of the items, one each
            order = np.argsort(keys, kind="stable")
            short[k] = (keys[order], of[order])
    doc, h = S.shingles(arr, SHINGLE, short=False)
    doc, h, _ = S.weighted(doc, h)
    n = np.bincount(doc, minlength=len(texts))
    start = np.cumsum(n) - n
    classes = {}
    factors = _factors()
    c_of = size_class(n)
    some = np.flatnonzero(n > 0)
    minima = _blocks(h, start[some], factors) if len(some) else None
    for c in np.unique(c_of[n > 0]):
        items = np.flatnonzero((c_of == c) & (n > 0))
        rows = rows_per_band(int(c))
        keys = _bands(minima[np.searchsorted(some, items)], rows)
        flat = keys.ravel()
        order = np.argsort(flat, kind="stable")
        classes[int(c)] = (rows, flat[order], np.repeat(items, keys.shape[1])[order])
    return {"ids": list(ids), "times": list(times or [1] * len(ids)), "h": h, "start": start, "n": n, "classes": classes, "short": short}


def _blocks(h: np.ndarray, at: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """(blocks, HASHES) minima of the shingles between consecutive bounds ``at``."""
    out = np.empty((len(at), len(factors)), np.uint32)
    high = (h >> np.uint64(32)).astype(np.uint32)
    for i, f in enumerate(factors):  # a coordinate orders the shingles by a multiplicative hash
        out[:, i] = np.minimum.reduceat(high * f, at)
    return out


def _candidates(h: np.ndarray, first: np.ndarray, n: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray]:
    """(document, item) pairs that share a band in some window; ``h`` lies in text order."""
    factors = _factors()
    docs, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    base = 1 << min(index["classes"])
    # blocks of the smallest class, never across documents
    per = -(-n // base)
    owner = np.repeat(np.arange(len(n)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    at = first[owner] + nth * base
    minima = np.empty((len(at), HASHES), np.uint32)
    lo = 0
    while lo < len(at):  # a slice of shingles at a time stays in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _SLICE)))
        end = at[hi] if hi < len(at) else len(h)
        minima[lo:hi] = _blocks(h[at[lo]:end], at[lo:hi] - at[lo], factors)
        lo = hi
    size = base
    for c in range(min(index["classes"]), max(index["classes"]) + 1):
        if size != 1 << c:  # two blocks of the class below make one
            size = 1 << c
            even = nth % 2 == 0
            pair = minima[even]
            follows = np.flatnonzero(even)
            has = follows + 1
            ok = (has < len(owner)) & (owner[np.minimum(has, len(owner) - 1)] == owner[follows])
            pair[ok] = np.minimum(pair[ok], minima[has[ok]])
            minima, owner, nth = pair, owner[even], nth[even] // 2
        if c not in index["classes"]:
            continue
        rows, keys, of = index["classes"][c]
        filled = np.zeros(1 << _FILTER_BITS, bool)  # most keys end here
        filled[keys >> np.uint64(64 - _FILTER_BITS)] = True
        for lo in range(0, len(owner), 8192):
            m = minima[lo:lo + 8192].copy()
            for step in (1, 2):
                k = np.arange(lo, lo + len(m)) + step
                ok = (k < len(owner)) & (owner[np.minimum(k, len(owner) - 1)] == owner[lo:lo + len(m)])
                m[ok] = np.minimum(m[ok], minima[k[ok]])
            band = _bands(m, rows)
            band = band.ravel()
            hit = np.flatnonzero(filled[band >> np.uint64(64 - _FILTER_BITS)])
            left = np.searchsorted(keys, band[hit], "left")
            found = np.searchsorted(keys, band[hit], "right") - left
            run = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
            items.append(of[np.repeat(left, found) + run])
            docs.append(np.repeat(owner[lo + hit // (HASHES // rows)], found))
    pairs = np.unique(np.stack([np.concatenate(docs), np.concatenate(items)]), axis=1)
    return pairs[0], pairs[1]


@functools.lru_cache(maxsize=1)
def _load(data: bytes) -> dict:
    return pickle.loads(data)


def _matches(texts: pa.Array, index: dict, threshold: float) -> list[tuple[int, int, int, int]]:
    """(row, item number, shared shingles, item's shingles) of the texts that contain an item."""
    return _long_matches(texts, index, threshold) + _short_matches(texts, index)


def _short_matches(texts: pa.Array, index: dict) -> list[tuple[int, int, int, int]]:
    if not index["short"]:
        return []
    words, counts = S.word_hashes(texts)
    out = []
    for k, (keys, items) in index["short"].items():
        doc, h = runs_of_words(words, counts, k)
        lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        for d, a, z in {(int(doc[i]), int(lo[i]), int(hi[i])) for i in np.flatnonzero(hi > lo)}:
            out += [(d, int(i), 1, 1) for i in items[a:z]]
    return sorted(out)


def _long_matches(texts: pa.Array, index: dict, threshold: float) -> list[tuple[int, int, int, int]]:
    if not index["classes"]:
        return []
    doc, h = S.shingles(texts, SHINGLE, short=False)
    n = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    first = np.cumsum(n) - n
    out = []
    have_of: tuple[int, np.ndarray] = (-1, h[:0])
    for d, i in zip(*_candidates(h, first, n, index)) if len(h) else []:
        if have_of[0] != d:
            have_of = (d, np.unique(h[first[d]:first[d] + n[d]]))
        item = index["h"][index["start"][i]:index["start"][i] + index["n"][i]]
        shared = int(np.isin(item, have_of[1], assume_unique=True).sum())
        if shared >= threshold * len(item) - 1e-9:
            out.append((int(d), int(i), shared, len(item)))
    return out


def _matcher(shipped, threshold: float):
    def run(batches):
        index = _load(shipped.value)
        for batch in batches:
            for lo, count in S.chunks(batch.column(1)):
                part = batch.slice(lo, count)
                ids = part.column(0).to_pylist()
                out = [(ids[d], index["ids"][i], k, n, k / n) for d, i, k, n in _matches(part.column(1), index, threshold)
                       for _ in range(index["times"][i])]
                cols = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["doc_id", "item_id", "n_shared", "n_item", "containment"])
    return run


def _clean(shipped, threshold: float, at: int):
    def run(batches):
        index = _load(shipped.value)
        for batch in batches:
            for lo, count in S.chunks(batch.column(at)):
                part = batch.slice(lo, count)
                keep = np.ones(count, bool)
                keep[[m[0] for m in _matches(part.column(at), index, threshold)]] = False
                yield part.filter(pa.array(keep))
    return run


def _indexes(items: DataFrame, block_chars: int):
    """Broadcast indexes of the items, a block at a time."""
    spark = prepared(items.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text is not null")
    items = items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times"))
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = total // block_chars + 1
    for b in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = block.collect()
        index = build_index([r["item_id"] for r in rows], [r["text"] for r in rows], [r["times"] for r in rows])
        if index["classes"] or index["short"]:
            yield spark.sparkContext.broadcast(pickle.dumps(index))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_item, containment) with containment >= threshold."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("text is not null")
    out = docs.sparkSession.createDataFrame([], RESULT)
    for shipped in _indexes(items, block_chars):
        out = out.unionByName(texts.mapInArrow(_matcher(shipped, threshold), RESULT))
    return out


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain none of ``items``, with all their columns; null texts stay."""
    for shipped in _indexes(items, block_chars):
        docs = docs.mapInArrow(_clean(shipped, threshold, docs.columns.index("text")), docs.schema)
    return docs


def op7_size_partitioned_containment(spark, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair with the item's containment."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM words, unnest(range(1, len(w) - 3)) AS r(i) WHERE len(w) >= 5),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM item_words, unnest(range(1, len(w) - 3)) AS r(i) WHERE len(w) >= 5),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id),
short_items AS (SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS s FROM item_words WHERE len(w) BETWEEN 1 AND 4),
short_docs AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM words, (SELECT DISTINCT k FROM short_items) ks, unnest(range(1, len(w) - k + 2)) AS r(i))
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item,
       count(*) / any_value(n_item)::DOUBLE AS containment
FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_item) - 1e-9
UNION ALL
SELECT doc_id, item_id, 1, 1, 1.0::DOUBLE FROM short_docs JOIN short_items USING (k, s)
"""
