"""Operator 12: ranked lexical search with limited accumulators, term at a time.

Documents are dealt over tasks; a task takes its documents in blocks, and a block
is a small inverted file: for each query term the places of the block's documents
that hold it and what the term adds to their scores. A query's terms are taken
rarest first. A document gets an accumulator when a term finds it, until the sum
of what the remaining terms can add at most is below the k-th best score known so
far (partial scores of the block, full scores of the task's earlier blocks): from
there on no accumulator is created, but those that exist are updated to the end,
so the scores of the survivors are exact. Every task hands on its k best documents
of each query, and the k best of these are the result: the same rows as full
scoring gives.

Terms are the maximal runs of digits, ASCII letters and non-ASCII characters of
the whole text, A-Z lower-cased. The collection's figures (N, L, df) come from a
first pass, which also keeps each document's counts of the query terms, so that
texts are cut into terms once. Queries go to the tasks in blocks of bounded size
(MAX_PAIRS distinct pairs of query and term), each block matched in a pass of its own.

Nulls and edges: a null text has no terms; rows with null item_id are one query of
their own (null id), rows of one item_id are one query with all their terms;
queries without a term give no rows. Every row of ``docs`` is a document, also rows
that repeat an id; equal scores are ranked by doc_id, nulls last. Extra columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, table

TOP = 50
#: Distinct (query, term) pairs that are broadcast at once.
MAX_PAIRS = 500_000
#: Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 1_000_000
_PART = 1 << 20  # bytes of a text cut into terms at once
_PIECES = 16  # the tasks' best documents of a query are merged in so many pieces first
_NO_ID = np.iinfo(np.int64).max

#: Bytes of terms: digits, letters (A-Z lower-cased), and all of non-ASCII characters; others end a term.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes):
    """Lists of the terms of a text, part by part."""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + _PART)
        while hi < len(text) and _TERM[text[hi]] != 32 and _TERM[text[hi - 1]] != 32:
            hi += 1
        yield text[lo:hi].translate(_TERM).split()
        lo = hi


def _query_terms(batches):
    for batch in batches:
        ids, out = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set().union(*terms((text or "").encode()))
            ids += [i] * len(found)
            out += [t.decode() for t in found]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["item_id", "term"])


def _count(shared):
    """For each document: number of terms, and the query terms (as numbers) it holds with their counts."""
    def run(batches):
        asked = [t.encode() for t in shared.value]
        number = {t: i for i, t in enumerate(asked)}
        for batch in batches:
            size, at, held, times = [], [0], [], []
            for text in batch.column(1).to_pylist():
                count, n = Counter(), 0
                for part in terms((text or "").encode()):
                    n += len(part)
                    count.update(part)
                mine = sorted(number[t] for t in count.keys() & number.keys())
                size.append(n)
                held += mine
                times += [count[asked[i]] for i in mine]
                at.append(len(held))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))], ["doc_id", "n", "terms", "tfs"])
    return run


class _Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


def _reached(total: np.ndarray, found: _Best, most: int, k: int) -> int:
    """A score that k documents have: full scores of earlier blocks, partial ones (of at most ``most``) of this."""
    full = int(found.score[k - 1]) if len(found.score) == k else 0
    if most <= full:
        return full
    known = np.concatenate([total[total > full], found.score])
    return int(np.partition(known, len(known) - k)[len(known) - k]) if len(known) >= k else full


def search_block(queries, best: list[_Best], weight: np.ndarray, doc: np.ndarray, start: np.ndarray,
                 place: np.ndarray, quotient: np.ndarray, top: np.ndarray, k: int) -> None:
    """Add the best documents of one block to ``best``.

    ``place[start[t]:start[t + 1]]`` are the ascending places (in ``doc``) of the
    documents that hold term t, ``quotient`` their factors of its weight, ``top``
    the largest factor of each term. ``queries``: term numbers, rarest first.
    """
    total = np.zeros(len(doc), np.int64)
    for terms_, found in zip(queries, best):
        bound = np.append(np.cumsum((weight[terms_] * top[terms_])[::-1])[::-1], 0)
        if not bound[0]:
            continue
        survivors = None
        for i, t in enumerate(terms_):
            a, z = start[t], start[t + 1]
            if survivors is None and bound[i] < _reached(total, found, bound[0] - bound[i], k):
                survivors = np.flatnonzero(total)
            if a == z:
                continue
            if survivors is None:
                total[place[a:z]] += weight[t] * quotient[a:z]
            else:
                at = a + np.searchsorted(place[a:z], survivors)
                at = np.minimum(at, z - 1)
                hit = place[at] == survivors
                total[survivors[hit]] += weight[t] * quotient[at[hit]]
        mine = np.flatnonzero(total) if survivors is None else survivors
        if len(mine):
            score = total[mine]
            if len(mine) > 4 * k:  # all that reach the k-th score, ties included
                high = score >= np.partition(score, len(score) - k)[len(score) - k]
                mine, score = mine[high], score[high]
            found.add(score, doc[mine])
            total[:] = 0


def _blocks(batches):
    """(doc, n, owner, term, tf) arrays of about a block each; a long batch is cut by its rows."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            held.append(part)
            docs += part.num_rows
            postings += len(part.column(2).flatten())
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield held
                held, docs, postings = [], 0, 0
    if held:
        yield held


def _arrays(parts):
    ids = [p.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False) for p in parts]
    size = [p.column(1).to_numpy(zero_copy_only=False) for p in parts]
    length = np.concatenate([p.column(2).value_lengths().to_numpy(zero_copy_only=False) for p in parts])
    term = np.concatenate([p.column(2).flatten().to_numpy(zero_copy_only=False) for p in parts])
    tf = np.concatenate([p.column(3).flatten().to_numpy(zero_copy_only=False) for p in parts])
    return np.concatenate(ids), np.concatenate(size), np.repeat(np.arange(len(length)), length), term, tf


def _search(shared, k: int):
    def run(batches):
        ids, queries, weight, n_docs, n_terms = shared.value
        weight = np.asarray(weight, np.int64)
        best = [_Best(k) for _ in queries]
        for parts in _blocks(batches):
            doc, size, owner, term, tf = _arrays(parts)
            m = 50 + (50 * size * n_docs) // n_terms if n_terms else size
            order = np.lexsort((owner, term))
            owner, term, tf = owner[order], term[order], tf[order]
            start = np.searchsorted(term, np.arange(len(weight) + 1))
            quotient = (1_000_000_000 * tf) // (1000 * tf + 20 * m[owner])
            top = np.zeros(len(weight), np.int64)
            np.maximum.at(top, term, quotient)
            search_block(queries, best, weight, doc, start, owner, quotient, top, k)
        out = [(np.full(len(b.doc), i), b) for i, b in enumerate(best) if len(b.doc)]
        if out:
            which = np.concatenate([i for i, _ in out])
            doc = np.concatenate([b.doc for _, b in out])
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in which], pa.int64()), pa.array(doc, pa.int64(), mask=doc == _NO_ID),
                 pa.array(np.concatenate([b.score for _, b in out]))], ["item_id", "doc_id", "score"])
    return run


def weight_of(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(items: DataFrame, docs: DataFrame, k: int = TOP) -> DataFrame:
    """``items(item_id, text)``, ``docs(doc_id, text)`` -> (item_id, rank, doc_id, score): the k best of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked_search")
    pairs = scratch.stage(items.select(F.col("item_id").cast("long").alias("item_id"), "text")
                          .mapInArrow(_query_terms, "item_id long, term string").distinct(), "queries")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = max(1, -(-pairs.count() // MAX_PAIRS))
    out = None
    for b in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else pairs
        found = _search_pairs(scratch, mine, texts, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    piece = Window.partitionBy("item_id", "piece").orderBy(*order)
    near = (out.withColumn("piece", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_PIECES)))
            .withColumn("rank", F.row_number().over(piece)).where(F.col("rank") <= k))
    last = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return near.withColumn("rank", last).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_pairs(scratch: Scratch, pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame | None:
    """The tasks' best documents for one block of queries, of at most about MAX_PAIRS pairs."""
    context = scratch.spark.sparkContext
    by_item: dict = {}
    for item, term in pairs.collect():  # bounded by the block
        by_item.setdefault(item, []).append(term)
    vocabulary = sorted({t for ts in by_item.values() for t in ts})
    if not vocabulary:
        return None
    counted = scratch.stage(texts.mapInArrow(_count(context.broadcast(vocabulary)),
                                             "doc_id long, n long, terms array<int>, tfs array<long>"), "counts")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {t: n for t, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    weight = [weight_of(n_docs, df.get(i, 0)) for i in range(len(vocabulary))]
    number = {t: i for i, t in enumerate(vocabulary)}
    ids = list(by_item)
    queries = [np.array(sorted((number[t] for t in by_item[i]), key=lambda t: (df.get(t, 0), t)), np.int64) for i in ids]
    shared = context.broadcast((ids, queries, weight, n_docs, n_terms))
    return scratch.stage(counted.where(F.size("terms") > 0)
                         .mapInArrow(_search(shared, k), "item_id long, doc_id long, score long"), "best")


def op12_limited_accumulators(spark, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


_RUNS = r"regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
with runs as (select doc_id, row_number() over () as r, {_RUNS} as ts from documents),
sized as (select doc_id, r, ts, cast(len(ts) as bigint) as n from runs where len(ts) > 0),
figures as (select count(*) as nn, cast(sum(n) as bigint) as ll from sized),
tf as (select r, t, count(*) as tf from (select r, unnest(ts) as raw from sized) u,
       lateral (select {_LOWER.format('raw')} as t) l group by r, t),
asked as (select distinct item_id, {_LOWER.format('raw')} as t
          from (select item_id, unnest({_RUNS}) as raw from benchmark) q),
weights as (select t, cast(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) as bigint) as w
            from tf, figures where t in (select t from asked) group by t, nn),
scored as (select a.item_id, f.r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * nn) // ll))))) as bigint) as score
           from asked a join weights using (t) join tf f using (t) join sized s on s.r = f.r, figures
           group by a.item_id, f.r),
ranked as (select item_id, doc_id, score,
           row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
           from scored join sized using (r) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 50
"""
