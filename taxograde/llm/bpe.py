"""Operator 5: byte-pair encoding by a priority queue of merge ranks, and decoding.

A pre-token's bytes form a doubly linked list of symbols. A heap holds the rank
and place of every adjacent pair that some merge joins; the lowest rank (leftmost
first) is taken, entries whose symbols have changed since are skipped, and a
merge pushes the pairs it makes with its neighbours. Decoding concatenates the
byte strings of the vocabulary entries and reads the result as UTF-8, invalid
sequences replaced. The vocabulary and merges come from a tokenizer file whose
path is a parameter; it is read once in every Python worker.

Nulls and edges: a null text is encoded as empty (no ids); texts of any length
are handled in parts; the string of a special token is that token, as the
tokenizers library reads it; repeated rows and ids, and null ids, are kept row
by row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import prepared, table
from .word_chunks import ChunkEncoder

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the byte-level pre-tokenisation pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class Bpe:
    """Vocabulary, merges and the encoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        of_symbol = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = [vocab[c] for c in symbols]
        self.rank: dict[tuple[int, int], int] = {}
        self.left, self.right, self.merged = [], [], []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a], vocab[b]] = len(self.left)
            self.left.append(vocab[a])
            self.right.append(vocab[b])
            self.merged.append(vocab[a + b])
        strings = {i: bytes(of_symbol[c] for c in t) for t, i in vocab.items() if t not in self.special}
        strings.update({i: t.encode() for t, i in self.special.items()})
        size = max(strings) + 1
        self.pool = np.frombuffer(b"".join(strings.get(i, b"") for i in range(size)), np.uint8)
        self.length = np.array([len(strings.get(i, b"")) for i in range(size)], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        ids = [self.byte_ids[b] for b in data]
        n = len(ids)
        rank = self.rank.get
        heap = []
        for i in range(n - 1):
            r = rank((ids[i], ids[i + 1]))
            if r is not None:
                heap.append(r * n + i)
        if not heap:
            return ids
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left, right, merged = self.left, self.right, self.merged
        while heap:
            r, i = divmod(pop(heap), n)
            j = after[i]
            if j >= n or ids[i] != left[r] or ids[j] != right[r]:
                continue  # stale: a neighbour or the symbol itself has been merged since
            ids[i], ids[j] = merged[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank((ids[i], ids[k]))
                if r is not None:
                    push(heap, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank((ids[h], ids[i]))
                if r is not None:
                    push(heap, r * n + h)
        return [x for x in ids if x >= 0]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            ids: list[int] = []
            for part in (self.cut.split(text) if self.cut else [text]):
                if part in self.special:
                    ids.append(self.special[part])
                else:
                    for word in self.words.findall(part):
                        ids += self.merge(word.encode())
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Concatenated vocabulary bytes as valid UTF-8."""
        out = []
        for lo in range(0, len(ids), 200_000):
            part = ids[lo:lo + 200_000]
            n = self.length[part]
            at = np.repeat(self.offset[part] - (np.cumsum(n) - n), n)
            out.append(self.pool[at + np.arange(len(at))].tobytes())
        data = b"".join(out)
        return data.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=1)
def _worker(path: str) -> tuple[Bpe, ChunkEncoder]:
    bpe = Bpe(path)
    return bpe, ChunkEncoder(bpe.encode_many, list(bpe.special))


def _round_trip(path: str):
    def run(batches):
        bpe, encoder = _worker(path)
        for batch in batches:
            for lo, n in S.chunks(batch.column(1)):
                part = batch.slice(lo, n)
                ids = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
                text = pa.array([bpe.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), text],
                                                 ["doc_id", "ids", "decoded"])
    return run


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of each row; ``ids`` holds little-endian unsigned 32-bit integers."""
    prepared(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(_round_trip(path or public_tokenizers.path(VOCABULARY)), "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """The columns of the query: counts and digests of ids and decoded text; and ``more``."""
    return encoded.select("doc_id", *more, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_heap_bpe(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of the encoding and decoding of every document."""
    return digests(encode_and_decode(table(spark, sf_dir, "documents")))
