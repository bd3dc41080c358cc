"""Corpus pipeline: the stages applied to ``documents``, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and hands the reread table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxograde.llm import pipeline
from taxograde.llm.common import Scratch, table

STAGES = pipeline.STAGES

#: No SQL: learned language models, weighted signatures and byte-pair merges are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last stage's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline as a registered query."""
    return run(spark, sf_dir)
