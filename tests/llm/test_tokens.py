import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from conftest import rows_of
from tokenizers import Tokenizer

from taxograde.llm import bpe, token_files
from taxograde.llm.common import Scratch
from taxograde.llm.elias_fano import EliasFano
from taxograde.llm.word_chunks import ChunkEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def samples(n=3000):
    rng = random.Random(1)
    parts = list("ab'sS.,!  \n\t 　éß12漢\U0001F642\x1c\x85\0Ⅷ½") + ["<|endoftext|>", " the", "'ll", " word."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_heap_bpe_equals_the_library(library):
    model = bpe.Bpe(PATH)
    encoder = ChunkEncoder(model.encode_many, list(model.special), kept=200)
    rng = random.Random(2)
    for t in samples():
        want = library.encode(t, add_special_tokens=False).ids
        got = np.frombuffer(encoder.encode(t, part=rng.choice([5, 10 ** 6])), "<u4")
        assert got.tolist() == want, repr(t)
        assert model.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def test_texts_encoded_together_equal_the_library(library):
    """Pieces of several texts are looked up once and asked of the library as one text."""
    encoder, _ = token_files._worker(PATH)
    rng = random.Random(12)
    texts = samples() + [" ".join(rng.choice(["word", "Word.", "l'eau", "x\x1c", "\x1cx", "\u6f22", "", "12,5", "(a)"]) for _ in range(60)) for _ in range(300)] + ["", " ", "a" * 50]
    for lo in range(0, len(texts), 400):
        part = texts[lo:lo + 400]
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        assert encoder.encode_all(part) == want
        assert encoder.encode_all(part, part=30) == want
    assert encoder.encode_all([]) == []
    # few calls of the library for many texts
    calls = []
    counted = ChunkEncoder(lambda t: calls.append(len(t)) or encoder.encode_many(t))
    counted.encode_all([f"a new{i} text{i}" for i in range(200)])
    assert len(calls) == 2 and sorted(calls) == [1, 400]


def test_invalid_byte_sequences_decode_like_the_library(library):
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert bpe.Bpe.decode(MODEL, np.array(ids, "<u4")).decode() == library.decode(ids, skip_special_tokens=False)


MODEL = bpe.Bpe(PATH)


def test_round_trip_of_the_table(documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in rows_of(bpe.digests(bpe.encode_and_decode(documents))):
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_awkward_rows_encode(awkward, empty):
    got = rows_of(bpe.encode_and_decode(awkward))
    assert len(got) == 9 and {r["doc_id"]: bytes(r["ids"]) for r in got}[2] == b""
    assert {r["doc_id"]: len(r["decoded"]) for r in got}[5] == 300_000
    assert bpe.encode_and_decode(empty).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 700):
        for top in (1, 10, 10 ** 6, 2 ** 50):
            v = np.sort(rng.integers(0, top, n))
            f = EliasFano.from_bytes(EliasFano.encode(v).to_bytes())
            assert f.all().tolist() == v.tolist()
            assert [f.get(i) for i in range(n)] == v.tolist()
            for _ in range(20):
                lo, hi = sorted(rng.integers(0, n + 1, 2))
                assert f.between(int(lo), int(hi)).tolist() == v[lo:hi].tolist()
            if n == 700:
                assert len(f.high) + len(f.low) <= n * (2 + max(0, np.log2(top / n)) + 1) / 8 + 8
    with pytest.raises(IndexError):
        EliasFano.encode(np.array([1, 2])).get(2)


def brute(rows, library):
    out, start = [], 0
    key = (lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for doc_id, text in sorted(rows, key=key):
        ids = library.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        out.append((doc_id, start, len(ids), token_files.checksum(np.array(ids))))
        start += len(ids)
    return out


def test_files_equal_brute_force(spark, documents, library, tmp_path):
    base = Scratch(spark, "t").path("files")
    manifest = token_files.write_token_files(documents, base, shard_tokens=20_000).cache()
    assert manifest.count() > 4
    from pyspark.sql import functions as F
    got = [(r["doc_id"], r["start"], r["n"], r["c"]) for r in rows_of(token_files.read_token_files(manifest, base).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n"), F.crc32("ids").alias("c")))]
    want = brute([(r.doc_id, r.text) for r in documents.collect()], library)
    assert sorted(got) == sorted(want)
    path = manifest.orderBy("part", "seq").first()["path"]
    file = token_files.TokenFile(open(path, "rb").read())
    assert file.document(0).tolist()[-1] == token_files.END_ID and len(file) == len(file.doc_ids(0, len(file)))
    # a task that runs again replaces its files by the same bytes
    before = open(path, "rb").read()
    token_files.write_token_files(documents, base, shard_tokens=20_000).count()
    assert open(path, "rb").read() == before


def test_awkward_rows_in_files(spark, awkward, empty, library):
    base = Scratch(spark, "t").path("files")
    manifest = token_files.write_token_files(awkward, base).cache()
    got = [(r["doc_id"], r["start"], len(r["ids"]) // 4) for r in rows_of(token_files.read_token_files(manifest, base))]
    want = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(got, key=str) == sorted([w[:3] for w in brute(want, library)], key=str)
    none = token_files.write_token_files(empty, Scratch(spark, "t").path("files"))
    assert token_files.read_token_files(none, base).count() == 0


def test_files_are_read_a_few_documents_at_a_time(spark, awkward, monkeypatch):
    """Boundaries and ids come through select: also over blocks, with null ids first."""
    rng = np.random.default_rng(4)
    names = [None, None, *sorted(rng.integers(-50, 10 ** 12, 40).tolist())]
    counts = rng.integers(1, 9, 42)
    ids = rng.integers(0, 50_000, counts.sum()).astype("<u4")
    file = token_files.TokenFile(token_files.pack(names, counts, ids.tobytes(), 50_000))
    for lo in range(0, 42, 5):
        hi = min(42, lo + 5)
        assert file.doc_ids(lo, hi) == names[lo:hi]
        assert np.diff(file.bounds.between(lo, hi + 1)).tolist() == counts[lo:hi].tolist()
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
