"""Operator 13: spelling variants by a bit-sliced position index.

The words of the corpus with their numbers of occurrences are the vocabulary. Two
words are near if one inserted, deleted or replaced code point tells them apart.
Near words are found block by block. A block's index holds, for every position and
letter, the set of the block's words with that letter there, one bit a word. A
query word is read letter by letter while two kinds of sets are tracked at once:
the words that match so far without error, and those that match with one error,
one set for each way the positions may be shifted by it (none: replaced; by one
to either side: inserted, deleted). All queries of a block advance together, 64
words of the block at a time.

Blocks. The shorter of two near words (length L) differs from the other at one
place of its window [lo, hi), and outside the window the two are equal. So words
are grouped by (L, lo, hi, letters outside the window), first with the two halves
of a word as windows. A group of more than GROUP words is split into the two
halves of its window, until the window is one place, where the alphabet bounds the
group: 90 letters, and 90 * 90 words that are one letter longer. Nothing is
dropped, and no group is unbounded. A pair counts in the window that holds the
first place at which its words differ, so it counts once.

Nulls and edges: null texts have no words; a null doc_id is hashed as an empty
string; rows that repeat an id count as rows; ties of n take the smallest word in
code-point order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch, salted_join, table

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One in EDITED runs loses a letter (the contract's planted misspellings).
EDITED = 199
GROUP = 4096
_PACK = 2048  # words of small groups indexed together
_PACK_CELLS = 16_000_000
_HELD = 100_000  # distinct words a task holds before it hands on their counts

#: Latin-1 bytes of words: A-Z lower-cased, a-z and C0-FF as they are; all else ends a word.
_LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The lower-cased runs of letters, a byte a code point."""
    return text.encode("latin-1", "replace").translate(_LETTER).split()


def altered(word: bytes, h: int, edited: int) -> bytes:
    if h % edited:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _counts(edited: int):
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs(text)).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if h % edited == 0:
                        word = altered(word, h, edited)
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
                if len(held) > _HELD:
                    yield _counted(held)
                    held.clear()
        if held:
            yield _counted(held)
    return run


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                       pa.array(list(held.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, edited: int = EDITED) -> DataFrame:
    """(word, n): words of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (texts.mapInArrow(_counts(edited), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def _window(lo, hi):
    """Group of a word for the window [lo, hi) of a shorter word of length ``size``."""
    after = hi + F.length("word") - F.col("size")
    key = F.concat_ws(":", F.col("size"), lo, hi, F.substring("word", F.lit(1), lo),
                      F.substring("word", after + 1, F.length("word")))
    return F.struct(lo.alias("lo"), hi.alias("hi"), key.alias("key"))


def _halves(rows: DataFrame, lo, hi) -> DataFrame:
    mid = F.floor((lo + hi) / 2).cast("int")
    return (rows.withColumn("w", F.explode(F.array(_window(lo, mid), _window(mid, hi))))
            .select("word", "n", "size", "w.lo", "w.hi", "w.key"))


def groups(scratch: Scratch, words: DataFrame, most: int = GROUP) -> DataFrame:
    """(word, n, size, lo, hi, key): every near pair shares a key; keys of over ``most`` words have windows of one place."""
    sizes = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= MIN_LENGTH)
    rows = words.select("word", "n", F.explode(sizes).alias("size"))
    rows = scratch.stage(_halves(rows, F.lit(0), F.col("size")), "windows")
    done = None
    while True:
        large = (rows.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("held"))
                 .where(F.col("held") > most).select("key"))
        large = scratch.stage(large, "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = salted_join(rows, large, "key", F.xxhash64("word"), "left_anti").select(rows.columns)
        done = small if done is None else done.unionByName(small)
        split = salted_join(rows, large, "key", F.xxhash64("word"))
        rows = scratch.stage(_halves(split, F.col("lo"), F.col("hi")), "windows")


class PositionIndex:
    """Sets of words, one bit a word, by position and letter; ``letters`` is padded with zeros to the longest word + 2."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        self.letters, self.lengths = letters, lengths
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.codes = codes.reshape(letters.shape)

    def bits(self, of: np.ndarray) -> np.ndarray:
        """Rows of booleans as rows of 64-bit sets."""
        packed = np.packbits(of, axis=-1, bitorder="little")
        wide = -(-of.shape[-1] // 64) * 8
        out = np.zeros((*packed.shape[:-1], wide), np.uint8)
        out[..., :packed.shape[-1]] = packed
        return out.view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        """The sets of one position, a row a letter."""
        return self.bits(self.codes[:, position] == np.arange(len(self.alphabet))[:, None])

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all pairs of words that one error tells apart, in both directions."""
        n = len(self.lengths)
        order = np.argsort(self.lengths, kind="stable")
        codes, lengths = self.codes[order], self.lengths[order]
        found_q, found_w = [], []
        none = np.zeros(((n + 63) // 64), np.uint64)
        sized = {int(x): self.bits((self.lengths == x)[None, :])[0] for x in np.unique(lengths)}
        every = self.bits(np.ones((1, n), bool))[0]
        # rows are queries, sorted by length; those that are read to their end leave at the front
        exact = np.tile(every, (n, 1))
        replaced, fewer, more = (np.zeros_like(exact) for _ in range(3))
        first, before, here, after = 0, None, self.at(0), self.at(1)
        for j in range(int(lengths[-1])):
            c = codes[first:, j]
            same = here[c]
            more = (more | exact) & after[c]
            replaced = (replaced & same) | (exact & ~same)
            fewer = exact if before is None else (fewer & before[c]) | exact
            exact = exact & same
            ended = int(np.searchsorted(lengths, j + 1, "right")) - first
            if ended:
                m = j + 1
                hit = ((replaced[:ended] & sized[m]) | (fewer[:ended] & sized.get(m - 1, none))
                       | ((more[:ended] | exact[:ended]) & sized.get(m + 1, none)))
                q, w = np.nonzero(hit)
                if len(q):
                    bit = np.unpackbits(hit[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    r, b = np.nonzero(bit)
                    found_q.append(order[first + q[r]])
                    found_w.append(w[r] * 64 + b)
                first += ended
                exact, replaced, fewer, more = exact[ended:], replaced[ended:], fewer[ended:], more[ended:]
            if first == n:
                break
            before, here, after = here, after, self.at(j + 2)
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_w)


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    width = int(lengths.max()) + 2
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width), lengths


def _near_of(rows: list[tuple]) -> pa.RecordBatch | None:
    """The near words found in whole groups: for each word their number, the largest n, and the smallest word of that n."""
    words = [r[0].encode("latin-1") for r in rows]
    letters, lengths = _matrix(words)
    of = np.unique([r[5] for r in rows], return_inverse=True)[1]
    size, lo, hi = (np.array([r[i] for r in rows]) for i in (2, 3, 4))
    q, w = PositionIndex(letters, lengths).near()
    one = (of[q] == of[w]) & (np.minimum(lengths[q], lengths[w]) == size[q])
    q, w = q[one], w[one]
    if not len(q):
        return None
    parts = []
    for a in range(0, len(q), 100_000):  # first place where the two differ
        x, y = q[a:a + 100_000], w[a:a + 100_000]
        parts.append(np.argmax(letters[x] != letters[y], axis=1))
    place = np.concatenate(parts)
    mine = (lo[q] <= place) & ((place < hi[q]) | (hi[q] == size[q]))
    q, w = q[mine], w[mine]
    if not len(q):
        return None
    n = np.array([r[1] for r in rows], np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
    # rows of one word may stand in several groups of the pack: each gives a row of its own
    order = np.lexsort((rank[w], -n[w], q))
    q, w = q[order], w[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    near = np.diff(np.append(first, len(q)))
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[i][0] for i in q[first]], pa.string()), pa.array(near, pa.int64()),
         pa.array(n[w[first]], pa.int64()), pa.array([rows[i][0] for i in w[first]], pa.string())],
        ["word", "n_near", "best_n", "best"])


def _near(batches):
    held: list[tuple] = []
    longest = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            longest = max(longest, len(row[0]))
            if held and row[5] != held[-1][5] and (len(held) >= _PACK or len(held) * longest > _PACK_CELLS):
                out = _near_of(held)
                if out is not None:
                    yield out
                held, longest = [], len(row[0])
            held.append(row)
    if held:
        out = _near_of(held)
        if out is not None:
            yield out


def variants(docs: DataFrame, edited: int = EDITED) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.stage(vocabulary(docs, edited), "words")
    dealt = groups(scratch, words).repartition("key").sortWithinPartitions("key", "word")
    found = (dealt.select("word", "n", "size", "lo", "hi", "key")
             .mapInArrow(_near, "word string, n_near long, best_n long, best string")
             .groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                  F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")))
    large = -F.col("b.less") >= RATIO * F.col("n")
    formed = scratch.stage(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("b.best")).alias("form"), F.when(large, -F.col("b.less")).alias("form_n")), "forms")
    return (formed.join(roots(scratch, formed.where("form is not null").select("word", "form")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of forms; reach doubles every round, and n grows RATIO-fold along a chain."""
    reach = forms.select("word", F.col("form").alias("root"))
    while True:
        step = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        on = salted_join(reach, step, "root", F.xxhash64("word"), "left")
        reach = scratch.stage(on.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
                              .observe(seen, F.count_if("moved").alias("moved")).drop("moved"), "roots")
        if not seen.get["moved"]:
            return reach


def op13_bit_sliced_variants(spark, sf_dir: str) -> DataFrame:
    """Form, root and near-word count of every word of the documents."""
    return variants(table(spark, sf_dir, "documents"))
