"""Write the fixture views as the tool's input files, with Spark.

Layout (under a fresh folder in the shared checkpoint location):

  techset/       hierarchy JSON derived from the documents' (lang, source) pairs
  mappings/      mapping_file=<domain>.csv/part-*.csv   (one logical file per domain)
  patents/       domain_dir=<domain>/tech_file=<tech>.csv/part-*.csv

Readers treat a ``key=value`` folder as the value and a folder named like a
file as that file, so Spark's own partitioned output is valid input.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import fixtures as fx
from .job import Paths

CSV_WRITE = {"header": "true", "escape": '"', "quote": '"',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_fixture(spark: SparkSession, sf: str, patents_view: str = "patents_raw") -> Paths:
    root = shared_path(spark, "fixture")
    tech = fx.view(spark, sf, "tech")
    per_domain = tech.groupBy("domain").agg(
        F.array_sort(F.collect_set("tech_name_raw")).alias("technologies"))
    techset = per_domain.agg(
        F.array_sort(F.collect_list("domain")).alias("domains"),
        F.array_sort(F.collect_list(F.struct("domain", "technologies"))).alias("items"))
    techset.coalesce(1).write.mode("overwrite").json(f"{root}/techset")

    mp = fx.view(spark, sf, "mapping_raw")
    (mp.withColumn("mapping_file", F.concat("domain", F.lit(".csv")))
       .orderBy("domain", "ord")
       .select("mapping_file", "tech_name", "code_cell")
       .write.mode("overwrite").options(**CSV_WRITE).partitionBy("mapping_file")
       .csv(f"{root}/mappings"))

    pr = fx.view(spark, sf, patents_view)
    (pr.withColumn("domain_dir", F.col("domain"))
       .withColumn("tech_file", F.concat("tech_name_raw", F.lit(".csv")))
       .orderBy("domain", "tech_name_raw", "ord")
       .select("domain_dir", "tech_file", F.col("patent_id").alias("patent id"), "title", "abstract")
       .write.mode("overwrite").options(**CSV_WRITE).partitionBy("domain_dir", "tech_file")
       .csv(f"{root}/patents"))

    return Paths(techset=f"{root}/techset", mappings_dir=f"{root}/mappings",
                 patents_dir=f"{root}/patents", outputs_dir=f"{root}/outputs")
