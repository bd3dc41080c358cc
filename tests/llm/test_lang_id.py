import zlib

import numpy as np
from conftest import rows_of
from pyspark.sql import functions as F

from taxograde.llm import lang_id as L


def phrases(text, sample, segment=L.SEGMENT):
    """Greedy cross-parsing by substring search."""
    n = 0
    for lo in range(0, len(text), segment):
        part = text[lo:lo + segment]
        at = 0
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at:at + size + 1] in sample:
                size += 1
            n += 1
            at += size
    return n


def test_automata_equal_substring_search():
    rng = np.random.default_rng(0)
    samples = {"x": "".join(rng.choice(list("abc "), 400)), "y": "".join(rng.choice(list("abd "), 400))}
    model = L.Model(samples)
    texts = ["".join(rng.choice(list("abcd "), n)) for n in (1, 5, 255, 256, 257, 700)] + ["abc"]
    counts, n = model.phrases(texts)
    for k, name in enumerate(model.names):
        want = [phrases(t, samples[name]) for t in texts]
        got = counts[k].astype(int).tolist()
        assert got == want
    assert n.tolist() == [len(t) for t in texts]


def test_held_out_accuracy(spark, documents):
    out = L.identify(documents, L.learn(documents.where(L.fold_of(F.col("doc_id")) != 1)))
    lang = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in rows_of(out) if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 30 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_awkward_rows(awkward, empty):
    samples = L.learn(awkward)
    assert set(samples) <= {"en", "fr", "es"}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows_of(L.identify(awkward, samples))}
    assert got[2] == got[3] == got[4] == got[6] == ("und", 0.0) and got[5][0] == "en"
    assert L.learn(empty) == {} and L.identify(empty, samples).count() == 0
    assert {r["lang_pred"] for r in rows_of(L.identify(awkward, {}))} == {"und"}
    kept = rows_of(L.accepted(awkward, samples))
    assert sorted(map(str, (r["doc_id"] for r in kept))) == sorted(map(str, [1, 1, -7, 5]))


def test_sample_is_bounded_and_ignores_the_held_out_fold(documents):
    samples = L.learn(documents.where(L.fold_of(F.col("doc_id")) != 1))
    assert all(len(s) <= L.SAMPLE_CHARS + L.SAMPLE_DOCS for s in samples.values())
