"""Tables that are rewritten group by group, without a file for every group.

Each write appends one folder ``version=<n>`` with the rows of the groups it
rewrites; the newest version of a group counts. Nothing that was written before is
touched, so a write that dies leaves the table as it was and a repeated write is
harmless. When there are MAX_VERSIONS folders, the next write puts the newest rows
of all groups into its folder and deletes the older ones: the number of files
depends on the number of writes since, not on the number of groups.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import child_names, delete_path

MAX_VERSIONS = 32
_VERSION = "version"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions in ``path``: those whose write has finished."""
    found = (re.fullmatch(rf"{_VERSION}=(\d+)", name) for name in child_names(spark, path))
    return sorted(int(m[1]) for m in found if m and "_SUCCESS" in child_names(spark, f"{path}/{m[0]}"))


def read_latest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The rows of each group (equal ``keys``) from its newest version."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    with_version = StructType([*schema.fields, StructField(_VERSION, LongType())])
    rows = (spark.read.schema(with_version).option("basePath", path)
            .parquet(*[f"{path}/{_VERSION}={n}" for n in known]))
    if len(known) > 1:
        newest = F.max(_VERSION).over(Window.partitionBy(*keys))
        rows = rows.withColumn("_newest", newest).where(F.col(_VERSION) == F.col("_newest")).drop("_newest")
    return rows.drop(_VERSION)


def write_groups(df: DataFrame, path: str, schema: StructType, keys: Sequence[str], files: int | None = None) -> None:
    """Rewrite the groups of ``df``; ``files`` bounds the number of files written (default: as the plan has it)."""
    spark = df.sparkSession
    known = versions(spark, path)
    new = (max(known) if known else 0) + 1
    rows = df.select(*schema.fieldNames())
    full = len(known) >= MAX_VERSIONS
    if full:
        old = read_latest(spark, path, schema, keys).join(rows.select(*keys).distinct(), list(keys), "left_anti")
        rows = rows.unionByName(old.select(*schema.fieldNames()))
    if files:
        rows = rows.coalesce(files)
    rows.write.mode("overwrite").parquet(f"{path}/{_VERSION}={new}")
    if full:
        for n in known:
            delete_path(spark, f"{path}/{_VERSION}={n}")
