"""T1 restart: a second run sees only new files; T2 counts carry over."""

from pyspark.sql import functions as F

from taxograde.plans import catalog
from taxograde.session import shared_path
from taxograde.sources.sinks import read_summary
from taxograde.streaming.incremental import read_running, running_rates, validate_stream

from conftest import SF_SMALL


def test_restart(spark):
    inf = catalog.inferred_lists(spark, SF_SMALL).select(
        "domain", "tech_name_raw", F.col("ord").alias("batch_idx"), "patent_id", "inferred_codes")
    res = catalog.resolved(spark, SF_SMALL)
    src = shared_path(spark, "t", "src")
    out = shared_path(spark, "t", "out")
    run_dir = shared_path(spark, "t", "run")
    first, second = inf.where(F.col("batch_idx") % 2 == 0), inf.where(F.col("batch_idx") % 2 == 1)
    first.write.parquet(f"{src}/part1")
    validate_stream(spark, src + "/*", res, out, f"{out}/_ck").awaitTermination()
    running_rates(spark, src + "/*", res, f"{run_dir}/t", f"{run_dir}/_ck").awaitTermination()
    n1 = read_summary(spark, f"{out}/summary").agg(F.sum("n_patents")).first()[0]
    assert n1 == first.count()
    validate_stream(spark, src + "/*", res, out, f"{out}/_ck").awaitTermination()
    assert read_summary(spark, f"{out}/summary").agg(F.sum("n_patents")).first()[0] == n1
    second.write.parquet(f"{src}/part2")
    validate_stream(spark, src + "/*", res, out, f"{out}/_ck").awaitTermination()
    running_rates(spark, src + "/*", res, f"{run_dir}/t", f"{run_dir}/_ck").awaitTermination()
    assert read_summary(spark, f"{out}/summary").agg(F.sum("n_patents")).first()[0] == inf.count()
    assert read_running(spark, f"{run_dir}/t").agg(F.sum("n_patents")).first()[0] == inf.count()


def test_technologies_without_answers(spark):
    """A technology that no file has answered yet has its row, with no patents."""
    res = catalog.resolved(spark, SF_SMALL)
    src, out = shared_path(spark, "t", "src"), shared_path(spark, "t", "out")
    one = catalog.inferred_lists(spark, SF_SMALL).where("tech_name_raw = 'src1'").select(
        "domain", "tech_name_raw", F.col("ord").alias("batch_idx"), "patent_id", "inferred_codes")
    one.write.parquet(f"{src}/part1")
    validate_stream(spark, src + "/*", res, out, f"{out}/_ck").awaitTermination()
    got = read_summary(spark, f"{out}/summary")
    assert got.count() == res.count() and got.where("n_patents = 0").count() > 0
    assert {r["tech_name_raw"] for r in got.where("n_patents > 0").collect()} == {"src1"}
