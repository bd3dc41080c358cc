"""Spelling variants: equal to brute force, also with groups split down to one place; awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import AWKWARD, SF_SMALL

from taxograde.llm import spelling as P
from taxograde.llm.common import Scratch

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute(docs, edited=P.EDITED):
    n = Counter()
    for d, text in docs:
        for w in RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % edited == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    return brute_words(n)


def brute_words(n):
    shared, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shared[w[:i], w[i + 1:]].add(w)
            less = w[:i] + w[i + 1:]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for ws in shared.values():
        for w in ws:
            near[w] |= ws - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found(df, edited=P.EDITED):
    got = P.variants(df, edited)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {tuple(r) for r in P.op13_bit_sliced_variants(spark, SF_SMALL).collect()}
    assert got == brute(docs) and len(got) > 500


def test_split_groups(spark):
    """Groups of hundreds of words with one stem, split to windows of one place; chains of forms; ties."""
    rng = random.Random(3)
    words = {}
    for stem in ("internationalish", "abcabcabc", "éàüßôî"):
        for _ in range(150):
            w = list(stem)
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(k, rng.choice("abéz")), lambda: w.insert(k, rng.choice("abéz")), lambda: w.pop(k)])()
            if len(w) >= 6:
                words["".join(w)] = rng.choice([5, 5, 6, 24, 25, 130, 700])
    text = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(words.items())]
    df = spark.createDataFrame(text, "doc_id long, text string")
    want = brute(text, 10 ** 12)
    assert any(x[1] and x[1] != x[2] for x in want)
    scratch = Scratch(spark, "t")
    v = spark.createDataFrame([(w, c) for w, c in words.items()], "word string, n long")
    sizes = P.groups(scratch, v, 4).groupBy("key", "lo", "hi").count().collect()
    assert all(r["count"] <= 4 or r["hi"] - r["lo"] == 1 for r in sizes)
    before, P.groups.__defaults__ = P.groups.__defaults__, (4,)
    try:
        assert found(df, 10 ** 12) == want
    finally:
        P.groups.__defaults__ = before
    assert found(df, 10 ** 12) == want


def test_index_is_levenshtein():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab\xe9") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    letters, lengths = P._matrix([w.encode("latin-1") for w in words])
    q, w = P.PositionIndex(letters, lengths).near()
    got = Counter(zip(q.tolist(), w.tolist()))

    def one(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    assert set(got) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one(a, b)}
    assert set(got.values()) == {1} and np.all(lengths > 0)


def test_planted_misspellings(spark):
    docs = [(i, "spelling variants grouping " * 20) for i in range(60)]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), 7)
    assert got == brute(docs, 7) and any(x[1] for x in got)


def test_awkward(spark, awkward, empty):
    assert found(awkward) == brute([(r[0], r[1]) for r in AWKWARD])
    assert found(empty) == set()
    a, b = "z" * 20_000, "z" * 20_001
    long = [(1, f"{a} {b}"), (2, "a" * 6)] * 5
    assert found(spark.createDataFrame(long, "doc_id long, text string"), 10 ** 12) == {
        (a, None, a, 5, 1, None), (b, None, b, 5, 1, None), ("a" * 6, None, "a" * 6, 5, 0, None)}
