"""Stages of the corpus pipeline, each built on one operator.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. Rows
with null text or without a letter go in the first stage; rows with null doc_id
go through all stages, but cannot be classed as duplicates. Extra columns are
carried along until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, lang_id, near_dedup, secrets_scan
from .common import prepared, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (operator 8): texts of no learned language go."""
    prepared(spark)
    return lang_id.accepted(docs, lang_id.learn(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (operator 1): of each class the row with the smallest id stays.

    Rows of one id and different texts are classed apart, so no text goes unless
    an equal or near-duplicate one stays.
    """
    prepared(spark)
    return near_dedup.near_duplicate_rows(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (operator 7): documents that contain an item go."""
    prepared(spark)
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (operator 10): secrets are masked in the text; n_chars follows."""
    prepared(spark)
    out = secrets_scan.redact(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return out


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE (operator 5): ids of every text, with digests of the ids and of the decoded text."""
    prepared(spark)
    return bpe.digests(bpe.encode_and_decode(docs), "ids")


STAGES = [("language_id", language_stage), ("near_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("secrets", secrets_stage), ("bpe", encoding_stage)]
