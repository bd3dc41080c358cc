"""Operator 8: language identification by cross-parsing against suffix automata.

For each language a bounded sample of labelled text becomes a suffix automaton.
A text is parsed greedily into the longest phrases that occur in a language's
sample; the phrases, normalised by the sample's size (c log2 N / n, an estimate
of the cross entropy), are fewest for the language that wins.

The automata are dense tables, and the texts of a batch are cut into segments
of ``SEGMENT`` characters that are parsed side by side with numpy; a phrase ends
at the end of its segment, the same for all languages. Whole texts are parsed.

Learning uses only labelled rows: at most ``SAMPLE_DOCS`` documents per language
(smallest hash of doc_id) and ``SAMPLE_CHARS`` characters of them (fewer where
the tables of all languages would exceed ``TABLE_CELLS``). The number of
languages is a property of the labels; over ``MAX_LANGUAGES`` raises.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0,
as is every text when nothing is labelled. Rows with null lang or null doc_id
are not learned from (the fold needs an id) but are predicted. Ties go to the
alphabetically first language, with score 0. Repeated rows are predicted row by
row, extra columns ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import shingles as S
from .common import prepared, table

SAMPLE_DOCS = 64
SAMPLE_CHARS = 32_000
TABLE_CELLS = 24_000_000
MAX_LANGUAGES = 1000
SEGMENT = 256
LEAST_PHRASE = 1.75
RESULT = "doc_id long, lang_pred string, score double, phrase_length double"
#: Codes of characters: 0 unknown, 1 padding, 2 any non-letter, others the alphabet of the samples.
_PAD, _GAP, _FIRST, _CODES = 1, 2, 3, 96
_LETTER = re.compile(r"[^\W\d_]")


def fold_of(doc_id) -> F.Column:
    """The labelled rows' fold: crc32 of the id as text, modulo 3 (1: held out)."""
    return F.crc32(doc_id.cast("string")) % 3


def learn(docs: DataFrame) -> dict[str, str]:
    """Sample text of each language, from ``docs(doc_id, text, lang)``."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    w = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
              .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= SAMPLE_DOCS)
              .select("doc_id", "lang", "h").limit(SAMPLE_DOCS * MAX_LANGUAGES + 1).collect())
    if len({r["lang"] for r in picked}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not picked:
        return {}
    # at most SAMPLE_DOCS * MAX_LANGUAGES short rows; their texts are cut in Spark to what a language takes of them
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"], r["h"]) for r in picked],
                                            StructType([docs.schema["doc_id"], docs.schema["lang"], StructField("h", LongType())])).distinct()
    texts = rows.select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text")).join(F.broadcast(ids), ["doc_id", "lang"])
    nth = Window.partitionBy("lang").orderBy("h", "doc_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    cut = (texts.withColumn("before", F.coalesce(F.sum(F.length("text") + 1).over(nth), F.lit(0)))
           .where(F.col("before") < SAMPLE_CHARS)
           .select("lang", "before", F.substring("text", F.lit(1), F.lit(SAMPLE_CHARS) - F.col("before")).alias("text")))
    out: dict[str, str] = {}
    for r in sorted(cut.collect(), key=lambda r: r["before"]):  # under SAMPLE_CHARS + SAMPLE_DOCS characters a language
        out[r["lang"]] = out.get(r["lang"], "") + r["text"] + " "
    return out


def _codes(text: str, alphabet: np.ndarray) -> np.ndarray:
    return alphabet[np.frombuffer(text.encode("utf-32-le"), np.uint32)]


def alphabet_of(samples: list[str]) -> np.ndarray:
    """Code of every code point: the letters of the samples, rare ones sharing a code."""
    letters, n = np.unique(np.array([ord(c) for s in samples for c in s.lower() if c.isalpha()], np.int64), return_counts=True)
    table_ = np.full(0x110000, _GAP, np.uint8)
    table_[[i for i in range(0x110000) if chr(i).isalpha()]] = 0
    for i, cp in enumerate(letters[np.argsort(-n, kind="stable")]):
        table_[cp] = _FIRST + i if i < _CODES else _FIRST + _CODES - 1 - int(cp) % 32
    return table_


def suffix_automaton(codes: np.ndarray, width: int) -> np.ndarray:
    """Dense transitions of the suffix automaton of ``codes``, as premultiplied states (0: none).

    State 0 is the root, state 1 stands for the padding after a text.
    """
    step: list[dict[int, int]] = [{}, {}]
    link, length = [-1, -1], [0, 0]
    last = 0
    for c in codes.tolist():
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.zeros((len(step), width), np.int32)
    for s, t in enumerate(step):
        for c, to in t.items():
            out[s, c] = to * width
    out[:, _PAD] = width
    return out.ravel()


class Model:
    """Alphabet and automata of all languages."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        self.alphabet = alphabet_of([samples[n] for n in self.names])
        used = int(self.alphabet.max()) + 1
        most = max(1000, TABLE_CELLS // (2 * used * max(1, len(self.names))))
        self.tables, self.bits = [], []
        for n in self.names:
            codes = _codes(samples[n].lower()[:most], self.alphabet)
            self.tables.append(suffix_automaton(codes, used))
            self.bits.append(math.log2(max(2, len(codes))))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """((languages, texts) phrase counts, characters of each text)."""
        low = [t.lower() for t in texts]
        n = np.array([len(t) for t in low], np.int64)
        per = -(-n // SEGMENT)
        owner = np.repeat(np.arange(len(n)), per)
        grid = np.full(len(owner) * SEGMENT, _PAD, np.uint8)
        shift = np.repeat((np.cumsum(per) - per) * SEGMENT - (np.cumsum(n) - n), n)
        codes = _codes("".join(low), self.alphabet)
        grid[np.arange(len(codes)) + shift] = codes
        grid = np.ascontiguousarray(grid.reshape(-1, SEGMENT).T).astype(np.int32)
        out = np.zeros((len(self.names), len(texts)))
        for k, t in enumerate(self.tables):
            state = np.zeros(len(owner), np.int32)
            count = np.zeros(len(owner), np.int32)
            at = np.empty_like(state)
            for c in grid:
                begins = state == 0  # no open phrase: at the start, or after a letter that no sample has
                np.add(state, c, out=at)
                t.take(at, out=state, mode="clip")
                miss = state == 0
                begins |= miss
                begins &= c != _PAD
                count += begins
                miss = np.flatnonzero(miss)
                state[miss] = t[c[miss]]
            out[k] = np.bincount(owner, count, len(texts))
        return out, n

    def predict(self, texts: list) -> list[tuple[str, float, float]]:
        """(language, score, mean phrase length) of each text."""
        some = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        out = [("und", 0.0, 0.0)] * len(texts)
        if not self.names or not some:
            return out
        counts, n = self.phrases([texts[i] for i in some])
        cost = counts * np.array(self.bits)[:, None] / n
        best = cost.argmin(axis=0)
        ordered = np.sort(cost, axis=0)
        score = 1 - ordered[0] / ordered[1] if len(self.names) > 1 else np.ones(len(some))
        for i, k, s, p in zip(some, best, score, n / counts.min(axis=0)):
            out[i] = (self.names[k], float(s), float(p))
        return out


@functools.lru_cache(maxsize=1)
def _load(data: bytes) -> Model:
    return Model(pickle.loads(data))


def _predict(shipped):
    def run(batches):
        model = _load(shipped.value)
        for batch in batches:
            for lo, n in S.chunks(batch.column(1)):
                part = batch.slice(lo, n)
                lang, score, size = zip(*model.predict(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array(size, pa.float64())],
                                                 ["doc_id", "lang_pred", "score", "phrase_length"])
    return run


def _accept(shipped, at: int, least: float):
    def run(batches):
        model = _load(shipped.value)
        for batch in batches:
            for lo, n in S.chunks(batch.column(at)):
                part = batch.slice(lo, n)
                yield part.filter(pa.array([lang != "und" and size >= least
                                            for lang, _, size in model.predict(part.column(at).to_pylist())], pa.bool_()))
    return run


def accepted(docs: DataFrame, samples: dict[str, str], least: float = LEAST_PHRASE) -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns.

    Rejected are ``und`` and texts of which even the best language's phrases are
    shorter than ``least`` characters on average.
    """
    spark = prepared(docs.sparkSession)
    shipped = spark.sparkContext.broadcast(pickle.dumps(samples))
    return docs.mapInArrow(_accept(shipped, docs.columns.index("text"), least), docs.schema)


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """(doc_id, lang_pred, score, phrase_length) of each row; needs only doc_id and text."""
    spark = prepared(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(_predict(spark.sparkContext.broadcast(pickle.dumps(samples))), RESULT)


def op8_cross_parsing(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows of the other folds."""
    docs = table(spark, sf_dir, "documents")
    samples = learn(docs.where(fold_of(F.col("doc_id")) != 1))
    out = identify(docs, samples)
    return out.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
