"""Operator 2: token ids in binary files with Elias-Fano document boundaries.

Texts are dealt by ranges of doc_id, sorted, encoded by the tokenizers library
and appended to shard files of at most about ``SHARD_TOKENS`` ids. A file holds
the concatenated ids (2 bytes each where the vocabulary allows, else 4), an
Elias-Fano sequence of the document boundaries with its select structure, and
another of the doc_ids. File names follow from the partition and the order
within it and the bytes from the rows alone, and a file appears by a rename, so
a task that runs again replaces its own files by the same ones. The manifest is
a table (a row per file); documents are read back from the files.

Nulls and edges: a null text is an empty document (it has only the end id);
rows with null doc_id come first; rows of one doc_id follow each other in the
order of their texts; extra columns are ignored; an empty table writes no file
and gives an empty result. Long texts are encoded in parts.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shingles as S
from .common import Scratch, table
from .elias_fano import EliasFano
from .word_chunks import ChunkEncoder

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 8_000_000
ENCODED = 200  # pieces that the library encodes at once
READ_DOCS = 2000  # documents whose boundaries are selected at once
MAGIC = b"EFTOKEN1"
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"


def _fs(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def pack(doc_ids: list, counts: np.ndarray, ids: bytes, vocab: int) -> bytes:
    """The bytes of one file; ``ids`` are 32-bit, ``doc_ids`` ascending with nulls first."""
    width = 2 if vocab <= 1 << 16 else 4
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(counts)])).to_bytes()
    names = EliasFano.encode((known.astype(np.uint64) - np.uint64(least & (2 ** 64 - 1)))).to_bytes()
    head = json.dumps({"width": width, "null_ids": len(doc_ids) - len(known), "least_id": least,
                       "bounds": len(bounds), "names": len(names)}).encode()
    body = np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()
    return MAGIC + struct.pack("<I", len(head)) + head + bounds + names + body


class TokenFile:
    """A file read back: ids of document i lie between boundaries i and i + 1."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n = struct.unpack_from("<I", data, 8)[0]
        head, at = json.loads(data[12:12 + n]), 12 + n
        view = memoryview(data)
        self.bounds = EliasFano.from_bytes(view[at:at + head["bounds"]])
        at += head["bounds"]
        self.names = EliasFano.from_bytes(view[at:at + head["names"]])
        at += head["names"]
        self.null_ids, self.least_id = head["null_ids"], np.uint64(head["least_id"] & (2 ** 64 - 1))
        self.ids = np.frombuffer(view[at:], f"<u{head['width']}")

    def __len__(self) -> int:
        return self.bounds.n - 1

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.get(i):self.bounds.get(i + 1)]

    def doc_ids(self, lo: int, hi: int) -> list[int | None]:
        """The ids of documents ``lo`` to ``hi - 1``; those without one come first."""
        known = self.names.between(max(0, lo - self.null_ids), max(0, hi - self.null_ids)).astype(np.uint64) + self.least_id
        return [None] * (min(hi, self.null_ids) - min(lo, self.null_ids)) + known.astype(np.int64).tolist()


@functools.lru_cache(maxsize=1)
def _worker(path: str) -> tuple[ChunkEncoder, int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    vocab = tok.get_vocab()
    begins = np.zeros(max(vocab.values(), default=0) + 1, bool)  # ids of tokens that begin with a space
    begins[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True

    def encode_many(texts: list[str]) -> list[bytes]:
        out = []
        for lo in range(0, len(texts), ENCODED):
            part = texts[lo:lo + ENCODED]
            if len(part) == 1:
                out.append(np.array(tok.encode(part[0], add_special_tokens=False).ids, "<u4").tobytes())
                continue
            # pieces have their only space in front: one text of them all, cut again where a token begins with a space
            ids = np.array(tok.encode("".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(begins[ids])
            if len(cuts) == len(part) and all(t[0] == " " and t.count(" ") == 1 for t in part):
                cuts, ids = [*(4 * cuts).tolist(), 4 * len(ids)], ids.tobytes()
                out += [ids[a:z] for a, z in zip(cuts, cuts[1:])]
                continue
            e = tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(e.ids, "<u4").tobytes(), np.array(e.word_ids, np.int64)
            cuts = (4 * np.searchsorted(of, np.arange(len(part) + 1))).tolist()
            out += [ids[a:z] for a, z in zip(cuts, cuts[1:])]
        return out

    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    return ChunkEncoder(encode_many, special, kept=350_000), tok.get_vocab_size()


def _write(path: str, base: str, end_id: int, shard_tokens: int):
    def run(batches):
        encoder, vocab = _worker(path)
        fs, root = _fs(base)
        part = TaskContext.get().partitionId()
        seq, names, counts, held, tokens = 0, [], [], [], 0

        def flush():
            final = f"{root}/{part:06d}-{seq:05d}.tok"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(tmp := f"{root}/_{uuid.uuid4().hex}") as f:
                f.write(pack(names, np.array(counts, np.int64), b"".join(held), vocab))
            fs.move(tmp, final)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": final, "n_docs": len(names), "n_tokens": tokens}],
                                              pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                                                         ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            for lo, n in S.chunks(batch.column(1)):
                rows = batch.slice(lo, n)
                encoded = encoder.encode_all([text or "" for text in rows.column(1).to_pylist()])
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoded):
                    ids += end
                    names.append(doc_id)
                    counts.append(len(ids) // 4)
                    held.append(ids)
                    tokens += len(ids) // 4
                    if tokens >= shard_tokens:
                        yield flush()
                        seq, names, counts, held, tokens = seq + 1, [], [], [], 0
        if names:
            yield flush()
    return run


def write_token_files(docs: DataFrame, base: str, path: str | None = None, end_id: int = END_ID,
                      shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` as token files under ``base``; the lazily written manifest (a row per file)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    return rows.mapInArrow(_write(path or public_tokenizers.path(VOCABULARY), base, end_id, shard_tokens), MANIFEST)


def _read(base: str):
    def run(batches):
        fs, _ = _fs(base)
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(path) as f:
                    data = TokenFile(f.read())
                for lo in range(0, len(data), READ_DOCS):
                    hi = min(len(data), lo + READ_DOCS)
                    bounds = data.bounds.between(lo, hi + 1)
                    wide = [data.ids[a:z].astype("<u4").tobytes() for a, z in zip(bounds[:-1], bounds[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(data.doc_ids(lo, hi), pa.int64()), pa.array(before + bounds[:-1], pa.int64()),
                         pa.array(wide, pa.binary())], ["doc_id", "start", "ids"])
    return run


def read_token_files(manifest: DataFrame, base: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files of ``manifest``.

    ``start`` counts all ids before the document: sums per partition run in one
    small window over partitions, sums per file in a window inside each.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before_part"))
    w = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = (manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(w), F.lit(0))).join(parts, "part")
             .select("path", (F.col("before_part") + F.col("inside")).alias("before")))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "path").mapInArrow(_read(base), "doc_id long, start long, ids binary")


def op2_elias_fano_files(spark, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document, read back from the token files."""
    scratch = Scratch(spark, "token_files")
    base = scratch.path("files")
    manifest = scratch.stage(write_token_files(table(spark, sf_dir, "documents"), base), "manifest")
    return read_token_files(manifest, base).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def checksum(ids: np.ndarray) -> int:
    """The query's checksum of an id sequence, for tests."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
