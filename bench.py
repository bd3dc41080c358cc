"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_RUNS (default 3, median reported). Each query is executed in full into
Spark's ``noop`` sink, so the time is the job, not a transfer to the driver.
``validate_tech_x100`` grades the inferred table replicated 100 times (as the
baseline plan asks), derived from the documents table by Spark.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from taxograde.operators import grading  # noqa: E402
from taxograde.plans import catalog  # noqa: E402
from taxograde.session import get_session  # noqa: E402

HEADLINE = ["validate_tech", "match_patent", "evidence_topk", "resolve_expected",
            "assign_batches_auto", "batch_payload", "merge_responses", "validate_responses",
            "clean_patents", "token_estimate"]


def replicated_validate(spark, sf, times=100):
    # a table 100x larger would be read in many splits; the driver table is one
    # row group, so spread it over the session's cores before replicating it
    inf = catalog.inferred_lists(spark, sf).repartition(spark.sparkContext.defaultParallelism)
    rep = inf.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))) \
             .withColumn("patent_id", F.concat("patent_id", F.lit("#"), F.col("copy").cast("string")))
    res = catalog.resolved(spark, sf)
    m = grading.match_patents(rep, res)
    return grading.validate_tech(m, res)


def timed(fn, runs):
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = catalog.QUERIES
    timed(lambda: qs["validate_tech"](spark, sf), 1)  # warm-up (JVM, Python workers)
    out = {}
    for name in HEADLINE:
        out[name] = round(timed(lambda n=name: qs[n](spark, sf), runs), 3)
    out["validate_tech_x100"] = round(timed(lambda: replicated_validate(spark, sf), runs), 3)
    sf_name = os.path.basename(sf).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf_name}))


if __name__ == "__main__":
    main()
