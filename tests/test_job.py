"""Whole job on exported fixture files: resume and consolidated summary."""

from pyspark.sql import functions as F

from taxograde.plans import exports
from taxograde.plans.fake_infer import FixtureInfer
from taxograde.plans.job import run
from taxograde.operators.resume import read_checkpoints

from conftest import SF_SMALL


def test_resume_and_summary(spark):
    paths = exports.export_fixture(spark, SF_SMALL)
    first = run(spark, paths, FixtureInfer(), wait_min=0, wait_max=0)
    n_tech = first.processed.count()
    assert first.summary_all.count() == n_tech > 0
    # the original's CSV files: one per technology, and the consolidated one
    per_tech = spark.read.option("header", True).csv(paths.summary_csv)
    assert per_tech.count() == n_tech
    assert per_tech.select("file").distinct().count() == n_tech
    assert set(per_tech.columns) >= {"domain", "tech_name_raw", "verdict", "expected_codes"}
    everything = spark.read.option("header", True).csv(paths.summary_all_csv)
    assert everything.columns == ["domain", "tech_name_raw", "tech_name_expected", "n_patents",
                                  "rate_A", "rate_B", "rate_C", "rate_none", "verdict", "confidence"]
    assert everything.count() == n_tech

    def boom(payload):
        raise AssertionError("finished technologies must be skipped")

    second = run(spark, paths, boom, wait_min=0, wait_max=0)
    assert second.processed.count() == 0
    # the consolidated summary still holds every technology (not only this run's)
    assert second.summary_all.count() == n_tech
    assert spark.read.option("header", True).csv(paths.summary_all_csv).count() == n_tech
    ck = read_checkpoints(spark, paths.checkpoints)
    assert ck.where(F.col("status") == "done").select("domain", "tech_name_raw").distinct().count() == n_tech
