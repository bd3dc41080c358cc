"""Ranked search: equal to full scoring, for any block size; accumulators are limited; awkward rows."""

import random
import re
from collections import Counter

import numpy as np
from conftest import AWKWARD, SCHEMA, SF_SMALL

from taxograde.llm import ranked_search as R

RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def full(items, docs, k=50):
    """Every score, by the formula alone. ``items``: [(id, text)], ``docs``: [(id, text)]."""
    tf = [Counter(map(lower, RUN.findall(t or ""))) for _, t in docs]
    n_docs, n_terms = sum(1 for c in tf if c), sum(c.total() for c in tf)
    df = Counter(t for c in tf for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(map(lower, RUN.findall(t or "")))
    out = set()
    for item, ts in asked.items():
        scored = []
        for (d, _), c in zip(docs, tf):
            m = 50 + (50 * c.total() * n_docs) // n_terms if n_terms else 0
            s = sum(R.weight_of(n_docs, df[t]) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts & c.keys())
            if s > 0:
                scored.append((-s, d is None, d, s))
        scored.sort(key=lambda x: x[:2] + ((x[2],) if x[2] is not None else (0,)))
        out |= {(item, r, d, s) for r, (_, _, d, s) in enumerate(scored[:k], 1)}
    return out


def searched(spark, items, docs, k=50):
    got = R.search(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


def test_equals_full_scoring(spark, monkeypatch):
    rng = random.Random(5)
    docs = [(i, words(rng, rng.randint(0, 60))) for i in range(900)] + [(7, "w1 w2 w3"), (3, None), (900, "w5 " * 3000)]
    items = [(i, words(rng, 12)) for i in range(25)] + [(25, None), (26, "nowhere"), (1, "w9 W10")]
    want = full(items, docs, 10)
    assert searched(spark, items, docs, 10) == want
    monkeypatch.setattr(R, "BLOCK_DOCS", 64)  # in this process the blocks of the driver's own call only
    number = {t: i for i, t in enumerate(sorted({t for _, x in items for t in (x or "").lower().split()}))}
    assert number and searched(spark, items, docs, 3) == full(items, docs, 3)


def test_accumulators_are_limited():
    """Once the bound is under the k-th score nothing new is scored, and what is kept is exact."""
    n = 5000
    rng = np.random.default_rng(1)
    rare, common = np.sort(rng.choice(n, 40, replace=False)), np.arange(n)
    place = np.concatenate([rare, common])
    quotient = np.concatenate([np.full(40, 900_000), rng.integers(1, 100_000, n)])
    weight, top = np.array([9000, 10]), np.array([900_000, 100_000])
    best, touched = [R._Best(10)], []

    class Watched(np.ndarray):
        def __setitem__(self, key, value):
            touched.append(np.size(key) if not isinstance(key, slice) else 0)
            super().__setitem__(key, value)
    real = np.zeros
    try:
        R.np.zeros = lambda *a, **k: real(*a, **k).view(Watched)
        R.search_block([np.array([0, 1])], best, weight, np.arange(n), np.array([0, 40, 40 + n]), place, quotient, top, 10)
    finally:
        R.np.zeros = real
    assert max(touched) <= 40  # the common term created no accumulator
    score = 9000 * 900_000 + 10 * quotient[40:][rare]
    order = np.lexsort((rare, -score))[:10]
    assert best[0].doc.tolist() == rare[order].tolist() and best[0].score.tolist() == score[order].tolist()


def test_ties_take_the_smallest_ids(spark):
    docs = [(i, "alpha beta") for i in range(200, 0, -1)] + [(None, "alpha beta"), (500, "gamma")] * 2
    got = searched(spark, [(1, "alpha")], docs, 5)
    assert {(r, d) for _, r, d, _ in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)}


def test_blocks_of_queries(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(i, words(rng, 30)) for i in range(200)]
    items = [(i, words(rng, 8)) for i in range(30)]
    monkeypatch.setattr(R, "MAX_PAIRS", 40)
    assert searched(spark, items, docs, 5) == full(items, docs, 5)


def test_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "Alpha TOKEN é word", 5), (None, "alpha", 5), (None, "eta", 5), (2, "", 5), (3, None, 5)],
                                  "item_id long, text string, score long")
    got = {tuple(r) for r in R.search(items, awkward).collect()}
    docs = [(r[0], r[1]) for r in AWKWARD]
    assert got == {t for t in full([(1, "Alpha TOKEN é word"), (None, "alpha"), (None, "eta")], docs)}
    assert R.search(items, empty).collect() == []
    assert R.search(spark.createDataFrame([], "item_id long, text string"), awkward).collect() == []
    assert SCHEMA


def test_terms():
    text = "A-Z Éa9 xÿ中文 tab\tend " * 40_000
    got = [t for part in R.terms(text.encode()) for t in part]
    assert got == [lower(t).encode() for t in RUN.findall(text)]


def test_oracle(spark):
    from oracle_check import digest, duck_rows
    got = R.op12_limited_accumulators(spark, SF_SMALL)
    cols, want = duck_rows(SF_SMALL, R.ORACLE)
    assert digest([tuple(r) for r in got.collect()], got.columns)[0] == digest(want, cols)[0]
