"""Operator 4: toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, letters of other scripts and full-width
forms that look like Latin ones to those, digits and signs inside words to the
letters they stand for (``1d10t``). Lexicon entries match at the beginning of a
word; an entry inside an exception phrase (the entry with the word before or
after it) does not count. The weights found, per length of the text, give the
score through a logistic curve.

All of it is learned from labelled rows, in three passes over a sample of about
``SAMPLE`` labelled documents (by hash of doc_id; near copies that share their
smallest shingle count once). Entries are word beginnings that stand almost only
in toxic documents and in at least ``SHARE`` of them; of nested ones the longest
that still covers nearly all their documents is kept, and only if its counts are
no chance. Exception phrases are contexts of an entry that occur only
in clean documents. Weights are log odds. The curve is fitted to the same
sample. Scores cover every row and whole texts.

Nulls and edges: null and empty texts score as texts without any entry; with no
labelled rows (or none toxic, or none clean) the lexicon is empty and every
score is 0. Rows with null doc_id are scored but never learned from; labels that
are null are skipped, and an id with both labels counts as toxic. Repeated rows
are scored row by row, extra columns ignored, empty tables give an empty result.
"""

from __future__ import annotations

import functools
import math
import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import Scratch, prepared, table

SAMPLE = 20_000
SHARE = 0.01
LEAST = 4
PURITY = 0.85
SAME, MORE = 0.9, 1.25
CHANCE = 1e-8  # of a chosen entry's counts, were it no sign of toxicity: far below one in all beginnings tried
MIN_PREFIX, MAX_PREFIX = 3, 12
MIN_ODDS = 1.0
#: Characters that look like a Latin letter, and what digits and signs stand for inside words.
HOMOGLYPHS = str.maketrans("аеорсухіјѕԁһӏтмвкнαοερτυνικβ", "aeopcyxijsdhltmbkhaoeptuvikb")
DIGITS = str.maketrans("0134578@$", "oieastbas")
_FOREIGN = re.compile(r"[Ͱ-ӿԀ-ԯ！-～]")
_SIGNS = re.compile(r"[0-9@$]+")
_WORD = re.compile(r"[^\W\d_]+")


def _unmask(m: re.Match) -> str:
    text, a, z = m.string, m.start(), m.end()
    inside = (a and text[a - 1].isalpha()) or (z < len(text) and text[z].isalpha())
    return m[0].translate(DIGITS) if inside else m[0]


def fold(text: str) -> str:
    """Lower case with homoglyphs and substitutions undone; the length is kept."""
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        text = "".join(chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else c for c in text).lower().translate(HOMOGLYPHS)
    return _SIGNS.sub(_unmask, text)


def fold_of(doc_id) -> F.Column:
    """The labels' fold: crc32 of the id as text, modulo 5 (0: held out)."""
    return F.crc32(doc_id.cast("string")) % 5


class Lexicon:
    """Entries with weights, exception phrases, and the curve that turns density into a score."""

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset(), slope: float = 1.0, offset: float = 0.0):
        self.weights, self.exceptions, self.slope, self.offset = weights, exceptions, slope, offset
        self.automaton = None
        if weights:
            import ahocorasick
            self.automaton = ahocorasick.Automaton()
            for entry in weights:
                self.automaton.add_word(entry, entry)
            self.automaton.make_automaton()

    def hits(self, text: str):
        """(entry, contexts) of every entry at the beginning of a word of a folded text."""
        if self.automaton is None:
            return
        for end, entry in self.automaton.iter(text):
            start = end - len(entry) + 1
            if start and text[start - 1].isalpha():
                continue
            word = _WORD.match(text, start)
            tail = _WORD.search(text, word.end(), word.end() + 40)
            head = _WORD.findall(text, max(0, start - 40), start)
            yield entry, ([f"{head[-1]} {word[0]}"] if head else []) + ([f"{word[0]} {tail[0]}"] if tail else [])

    def density(self, text: str | None) -> float:
        """Weight of the entries found, per root of the text's words."""
        text = fold(text or "")
        total = sum(self.weights[e] for e, near in self.hits(text) if not any(c in self.exceptions for c in near))
        return total / math.sqrt(10 + text.count(" ")) if total else 0.0

    def score(self, density: float) -> float:
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, self.slope * density + self.offset))))

    def __getstate__(self):
        return self.weights, self.exceptions, self.slope, self.offset

    def __setstate__(self, state):
        self.__init__(*state)


def _prefixes(text: str) -> set[str]:
    return {w[:n] for w in set(_WORD.findall(fold(text))) for n in range(MIN_PREFIX, min(len(w), MAX_PREFIX) + 1)}


def _count(found_in):
    """Documents of each label that hold a feature, summed over a task's rows in bounded pieces."""
    def out(counts):
        keys = list(counts)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                           pa.array(list(counts.values()), pa.int64())], ["feature", "toxic", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((f, toxic) for f in found_in(text))
                if len(counts) > 500_000:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)
    return run


def _totals(rows: DataFrame, found_in) -> DataFrame:
    counts = rows.select("text", "toxic").mapInArrow(_count(found_in), "feature string, toxic int, n long")
    return counts.groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                         F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))


def _odds(bad: int, good: int, n_bad: int, n_good: int) -> float:
    return math.log((bad + 0.5) / (n_bad + 1)) - math.log((good + 0.5) / (n_good + 1))


def _evidence(bad: int, good: int, n_bad: int, n_good: int) -> float:
    """How unlikely the counts are by chance (exponent of the Chernoff bound); 0 if not mostly toxic."""
    p, q, n = n_bad / (n_bad + n_good), bad / max(1, bad + good), bad + good
    if q <= p or bad / n_bad < PURITY * (bad / n_bad + good / n_good):
        return 0.0
    return n * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0))


def _stems(evidence: dict[str, float], bad: dict[str, int]) -> list[str]:
    """Of nested beginnings one: the shortest, lengthened while a longer one covers nearly all its toxic documents or tells clearly more."""
    longer: dict[str, list[str]] = {}
    for f in evidence:
        longer.setdefault(f[:-1], []).append(f)
    kept: set[str] = set()
    for f in sorted(evidence, key=lambda f: (len(f), f)):
        if any(f[:n] in kept for n in range(MIN_PREFIX, len(f) + 1)):
            continue
        while more := [x for x in longer.get(f, []) if bad[x] >= SAME * bad[f] or evidence[x] >= MORE * evidence[f]]:
            f = max(more, key=lambda x: (evidence[x], x))
        kept.add(f)
    return sorted(kept)


def _first_shingle(batches):
    for batch in batches:
        for lo, n in S.chunks(batch.column(0)):
            part = batch.slice(lo, n)
            d, h = S.shingles(part.column(0))
            key = np.full(n, 2 ** 64 - 1, np.uint64)
            np.minimum.at(key, d, h)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(key.view(np.int64))], ["text", "toxic", "near"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """Lexicon, exceptions and curve from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = marks.count()
    if n > sample:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(
        F.broadcast(marks), "doc_id")  # about `sample` rows of two numbers
    near = rows.select("text", "toxic").mapInArrow(_first_shingle, "text string, toxic int, near long")
    rows = scratch.stage(near.groupBy("near", "toxic").agg(F.min("text").alias("text")), "sample")
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_bad, n_good = size.get(1, 0), size.get(0, 0)
    least = max(LEAST, int(SHARE * n_bad))
    if not n_bad or not n_good:
        scratch.clear()
        return Lexicon({}, offset=-50.0)
    # word beginnings over-represented in toxic documents: at most one in `least` of all occurrences each
    ratio = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    some = _totals(rows, _prefixes).where((F.col("bad") >= least) & (ratio >= MIN_ODDS)).collect()
    counts = {r["feature"]: (r["bad"], r["good"]) for r in some}
    evidence = {f: _evidence(*c, n_bad, n_good) for f, c in counts.items()}
    entries = {f: _odds(*counts[f], n_bad, n_good) for f in _stems(
        {f: e for f, e in evidence.items() if e >= -math.log(CHANCE)}, {f: c[0] for f, c in counts.items()})}
    # a whole beginning that is not pure may become so without its exception phrases
    mixed = [r for r in some if r["good"] and r["feature"] not in entries and not any(
        r["feature"].startswith(e) or e.startswith(r["feature"]) for e in entries)]
    trial = Lexicon({**entries, **{r["feature"]: 1.0 for r in _longest(mixed)}})
    shipped = pickle.dumps(trial)
    near_of = {r["feature"]: (r["bad"], r["good"]) for r in _totals(rows, functools.partial(_contexts, shipped))
               .where("good > 0 and bad = 0").collect()}
    exceptions = {c for c, (_, good) in near_of.items() if good >= 2}
    trial.exceptions = exceptions
    shipped = pickle.dumps(trial)
    again = _totals(rows, functools.partial(_entries, shipped)).collect()
    weights = {r["feature"]: _odds(r["bad"], r["good"], n_bad, n_good) for r in again
               if r["bad"] >= least and _evidence(r["bad"], r["good"], n_bad, n_good) >= -math.log(CHANCE)}
    lexicon = Lexicon(weights, {c for c in exceptions if any(w.startswith(e) for w in c.split(" ") for e in weights)})
    shipped = pickle.dumps(lexicon)
    points = rows.select("text", "toxic").mapInArrow(functools.partial(_densities, shipped), "x double, y int")
    bins = points.groupBy(F.round("x", 3).alias("x"), "y").count().collect()
    lexicon.slope, lexicon.offset = _curve(np.array([r["x"] for r in bins]), np.array([r["y"] for r in bins]),
                                           np.array([r["count"] for r in bins], float))
    scratch.clear()
    return lexicon


def _longest(rows: list) -> list:
    """Of nested beginnings with the same counts the longest: the whole word, not a part of it."""
    best: dict[tuple, object] = {}
    for r in sorted(rows, key=lambda r: (len(r["feature"]), r["feature"])):
        best[r["feature"][:MIN_PREFIX], r["bad"], r["good"]] = r
    return list(best.values())


def _contexts(shipped: bytes, text: str) -> set[str]:
    return {c for _, near in _load(shipped).hits(fold(text)) for c in near}


def _entries(shipped: bytes, text: str) -> set[str]:
    lexicon = _load(shipped)
    return {e for e, near in lexicon.hits(fold(text)) if not any(c in lexicon.exceptions for c in near)}


def _densities(shipped: bytes, batches):
    lexicon = _load(shipped)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([lexicon.density(t) for t in batch.column(0).to_pylist()], pa.float64()),
                                          batch.column(1)], ["x", "y"])


def _curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small ridge."""
    a = np.stack([x, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (n * (y - p)) - 0.1 * w
        hess = (a * (n * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(w[0]), 1e-6), float(w[1])


@functools.lru_cache(maxsize=4)
def _load(data: bytes) -> Lexicon:
    return pickle.loads(data)


def _score(shipped):
    def run(batches):
        lexicon = _load(shipped.value)
        for batch in batches:
            for lo, n in S.chunks(batch.column(1)):
                part = batch.slice(lo, n)
                x = [lexicon.density(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.float64()),
                                                  pa.array([lexicon.score(v) for v in x], pa.float64())],
                                                 ["doc_id", "density", "score"])
    return run


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, density, score) of each row; needs only doc_id and text."""
    spark = prepared(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(_score(spark.sparkContext.broadcast(pickle.dumps(lexicon))), "doc_id long, density double, score double")


def op4_folded_lexicon(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of the other folds."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold_of(F.col("doc_id")) != 0)
    out = score(docs, learn(docs, labels))
    return out.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
