"""T1 from technology files: a further run takes only what is new; the result is the batch job's. Evidence over restarts."""

import json
import os

from pyspark.sql import functions as F

from taxograde.operators import grading
from taxograde.plans import catalog
from taxograde.plans.fake_infer import FixtureInfer
from taxograde.plans.job import Paths, run
from taxograde.session import shared_path
from taxograde.sources import sinks
from taxograde.streaming.incremental import evidence_stream, read_first
from taxograde.streaming.technology_files import summary_so_far, technology_stream

from conftest import SF_SMALL


def noted(folder):
    """An inference function that writes down the technologies it is asked about."""
    answer = FixtureInfer()

    def infer(payload):
        for b in json.loads(payload)["patent_batches"]:
            with open(f"{folder}/{b['tech_name_raw']}", "a") as f:
                f.write("x")
        return answer(payload)
    return infer


def test_only_new_files_are_processed(spark, tmpdir_fresh):
    patents, notes = f"{tmpdir_fresh}/patents", f"{tmpdir_fresh}/notes"
    os.makedirs(f"{patents}/D")
    os.makedirs(f"{tmpdir_fresh}/mappings")

    def technology(name, ids):
        tmp = f"{tmpdir_fresh}/{name}.tmp"
        with open(tmp, "w") as f:
            f.write("patent id,title,abstract\n" + "".join(f"{i},title {i},\"text,\n{i}\"\n" for i in ids))
        os.rename(tmp, f"{patents}/D/{name}.csv")
    with open(f"{tmpdir_fresh}/techset.json", "w") as f:
        json.dump({"domains": ["D"]}, f)
    with open(f"{tmpdir_fresh}/mappings/D.csv", "w") as f:
        f.write("tech,code\none,G01S\ntwo,H03W\nthree,G02S\n")
    paths = Paths(f"{tmpdir_fresh}/techset.json", f"{tmpdir_fresh}/mappings", patents, f"{tmpdir_fresh}/out")

    def stream():
        os.makedirs(notes, exist_ok=True)
        for x in os.listdir(notes):
            os.remove(f"{notes}/{x}")
        technology_stream(spark, paths, noted(notes), f"{tmpdir_fresh}/ck", wait_min=0, wait_max=0).awaitTermination()
        return set(os.listdir(notes))
    technology("one", range(1, 40))
    technology("two", range(40, 45))
    technology("none", [])
    assert stream() == {"one", "two"}
    assert stream() == set()
    technology("three", range(45, 60))
    assert stream() == {"three"}
    batch = run(spark, Paths(paths.techset, paths.mappings_dir, patents, f"{tmpdir_fresh}/out2"), FixtureInfer(), wait_min=0, wait_max=0)
    want = [tuple(r) for r in batch.summary_all.collect()]
    assert [tuple(r) for r in summary_so_far(spark, paths).collect()] == want and len(want) == 4
    assert {tuple(r) for r in sinks.read_evidence(spark, paths.evidence).select("tech_name_raw", "rank", "patent_id").collect()} \
        == {tuple(r) for r in sinks.read_evidence(spark, f"{tmpdir_fresh}/out2/evidence").select("tech_name_raw", "rank", "patent_id").collect()}
    assert {tuple(r) for r in sinks.read_coverage(spark, paths.coverage).select("tech_name_raw", "sent", "returned").collect()} \
        == {("one", 39, 39), ("two", 5, 5), ("three", 15, 15), ("none", 0, 0)}


def test_evidence_over_restarts(spark):
    inf = catalog.inferred_lists(spark, SF_SMALL).select(
        "domain", "tech_name_raw", F.col("ord").alias("batch_idx"), "patent_id", "inferred_codes")
    res = catalog.resolved(spark, SF_SMALL)
    src, out = shared_path(spark, "t", "src"), shared_path(spark, "t", "out")
    for k in (2, 0, 1):  # the first rows come last
        inf.where(F.col("batch_idx") % 3 == k).write.parquet(f"{src}/part{k}")
        evidence_stream(spark, src + "/*", res, f"{out}/t", f"{out}/ck", k=3).awaitTermination()
    want = grading.evidence(grading.match_patents(inf, res), ["batch_idx", "patent_id"], 3)
    cols = ["domain", "tech_name_raw", "rank", "patent_id", "code_match_level"]
    assert sorted(read_first(spark, f"{out}/t", 3).select(cols).collect()) == sorted(want.select(cols).collect())
