"""Sinks: per-technology summary (K1), consolidated summary (K2), CSV export.

K1 is a table of versions (``versions``): a write adds one folder with the
technologies it rewrites, and the newest row of a technology counts (idempotent,
as the original's per-technology CSV, without a file for each). K2 is derived from
all of K1, so technologies finished in earlier runs stay in it (the original kept
only the current run's rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ..functions.codes import safe_name
from ..operators.coverage import COUNTS
from ..operators.sizing import bounded_broadcast
from .versions import read_latest, write_groups

KEYS = ["domain", "tech_name_raw"]

SUMMARY_SCHEMA = StructType([
    StructField("tech_name_expected", StringType()),
    StructField("n_patents", LongType()),
    StructField("rate_A", DoubleType()),
    StructField("rate_B", DoubleType()),
    StructField("rate_C", DoubleType()),
    StructField("rate_none", DoubleType()),
    StructField("verdict", StringType()),
    StructField("confidence", DoubleType()),
    StructField("expected_codes", StringType()),
    StructField("resolution_tier", IntegerType()),
    StructField("domain", StringType()),
    StructField("tech_name_raw", StringType()),
])
SUMMARY_COLUMNS = ["domain", "tech_name_raw", "tech_name_expected", "n_patents", "rate_A",
                   "rate_B", "rate_C", "rate_none", "verdict", "confidence"]


def write_summary(results: DataFrame, path: str) -> None:
    """K1: replaces the rows of the technologies in ``results``."""
    write_groups(results, path, SUMMARY_SCHEMA, KEYS)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """All of K1, one row per technology; empty where nothing is written yet. Read errors are raised."""
    return read_latest(spark, path, SUMMARY_SCHEMA, KEYS)


EVIDENCE_SCHEMA = StructType([
    StructField("domain", StringType()), StructField("tech_name_raw", StringType()), StructField("rank", LongType()),
    StructField("patent_id", StringType()), StructField("code_match_level", StringType()),
    StructField("inferred_codes", ArrayType(StringType())), StructField("reasoning", ArrayType(StringType()))])


def write_evidence(samples: DataFrame, path: str) -> None:
    """W4's samples, replacing those of the technologies in ``samples``."""
    write_groups(samples, path, EVIDENCE_SCHEMA, KEYS)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, EVIDENCE_SCHEMA, KEYS)


COVERAGE_SCHEMA = StructType([StructField("domain", StringType()), StructField("tech_name_raw", StringType()),
                              *[StructField(c, LongType()) for c in COUNTS]])


def write_coverage(report: DataFrame, path: str) -> None:
    """Sent against returned, replacing the rows of the technologies in ``report``."""
    write_groups(report, path, COVERAGE_SCHEMA, KEYS)


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, COVERAGE_SCHEMA, KEYS)


def summary_all(spark: SparkSession, path: str, domains: DataFrame) -> DataFrame:
    """K2: every finished technology, ordered by hierarchy domain order, then name."""
    s = read_summary(spark, path)
    return (s.join(bounded_broadcast(domains.select("domain", "domain_pos")), "domain", "left")
             .orderBy(F.col("domain_pos").asc_nulls_last(), "domain", "tech_name_raw")
             .select(*SUMMARY_COLUMNS))


CSV_COLUMNS = [*SUMMARY_COLUMNS, "expected_codes"]


def export_csv(df: DataFrame, path: str) -> None:
    """CSV copy of a (small, ordered) summary: one file with a header line.

    ``coalesce(1)`` keeps the order of a sorted input; a summary has one row
    per technology, so one task writes it.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_summary_csv(summary: DataFrame, path: str) -> None:
    """K1 as the original's files: one CSV per technology, named
    ``<domain>__<tech>.csv`` with file-unsafe runs replaced (K6).

    Each name is a folder ``file=<name>`` of part files, replaced on rewrite
    (dynamic partition overwrite). Two technologies whose safe names collide
    share one file instead of overwriting each other.
    """
    (summary.select(*CSV_COLUMNS, export_name().alias("file"))
            .repartition("file")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("header", True).partitionBy("file").csv(path))


def export_name(domain_col="domain", tech_col="tech_name_raw"):
    """K6: the original's per-technology file name."""
    return F.concat(safe_name(domain_col), F.lit("__"), safe_name(tech_col), F.lit(".csv"))
