"""Resume at technology grain (I7): skip finished technologies (J3), mark done (K5).

Checkpoints are rows (domain, tech_name_raw, status) in Parquet: two key
columns instead of a joined string key, so no two technologies can collide.
Marking happens after the technology's summary is written, so a crash in
between only repeats work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tolerant import read_tolerant

KEYS = ["domain", "tech_name_raw"]
DONE = "done"


SCHEMA = "domain string, tech_name_raw string, status string"


def read_checkpoints(spark: SparkSession, path: str | None) -> DataFrame:
    """What can be read; a technology whose record is in an unreadable file counts as not done."""
    return read_tolerant(spark, path, SCHEMA)


def skip_done(tech: DataFrame, checkpoints: DataFrame) -> DataFrame:
    done = checkpoints.where(F.col("status") == DONE).select(*KEYS).distinct()
    return tech.join(done, KEYS, "left_anti")


def mark_done(tech: DataFrame, path: str) -> None:
    tech.select(*KEYS, F.lit(DONE).alias("status")).write.mode("append").parquet(path)
