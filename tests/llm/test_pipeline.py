import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from conftest import AWKWARD, SCHEMA, SF_SMALL, rows_of
from test_decontaminate import contained
from test_near_dedup import brute_classes
from tokenizers import Tokenizer

from taxograde.llm import queries, secrets_scan
from taxograde.llm.pipeline import STAGES


def test_run_equals_brute_force(spark, documents):
    """Every stage against its plain restatement, on what its predecessor kept."""
    docs = {r.doc_id: r.text for r in documents.collect()}
    out = {r["doc_id"]: r for r in rows_of(corpus_pipeline.run(spark, SF_SMALL))}
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = {i: t for i, t in docs.items() if any(c.isalpha() for c in t)}
    classes = brute_classes(kept)
    kept = {i: t for i, t in kept.items() if classes[i] == i}
    kept = {i: t for i, t in kept.items() if not any(contained(t, x) >= 0.8 for x in items)}
    path = public_tokenizers.path(secrets_scan.VOCABULARY)
    kept = {i: secrets_scan.masked(t, secrets_scan.spans_of(t, path)) for i, t in kept.items()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert set(out) == set(kept)
    for i, t in kept.items():
        assert np.frombuffer(out[i]["ids"], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_stages_keep_columns_and_take_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for name, stage in STAGES[:-1]:
            got = stage(spark, docs, SF_SMALL)
            assert got.columns == docs.columns, name
            got.collect()
        assert STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()
    one = rows_of(STAGES[1][1](spark, awkward, SF_SMALL))
    assert sorted((r["doc_id"] for r in one), key=str) == sorted([-7, 2, 3, 4, 5, 6, None], key=str)
    assert [r["n_chars"] for r in rows_of(STAGES[3][1](spark, awkward, SF_SMALL)) if r["doc_id"] is None] == [len("a text without an id, with " + secrets_scan.MASK)]
    assert len(AWKWARD[0]) == len(SCHEMA.split(","))


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert zlib.crc32(b"1") % 5 in range(5) and corpus_pipeline.ORACLE_SQL is None
