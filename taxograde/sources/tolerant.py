"""State tables whose unreadable files are skipped, as the original ignores an unreadable entry.

A truncated or otherwise corrupt Parquet file is passed over when it is read (not
only when the read is planned): its rows are missing, so the work that they record
is done again. ``unreadable_files`` names such files.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def read_tolerant(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """The readable rows of the Parquet table at ``path``; empty where there is none."""
    if not path or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(path)


def unreadable_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, error) of the files under ``path`` that give no row because they cannot be read.

    Only files without a readable row are opened, each in a task of its own turn.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file string, error string")
    given = read_tolerant(spark, path, schema).select(F.col("_metadata.file_path").alias("uri")).distinct()
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
              .load(path).select(F.col("_metadata.file_path").alias("uri"), "path", "content"))

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        for batch in batches:
            out = []
            for p, content in zip(batch["path"], batch["content"]):
                try:
                    pq.ParquetFile(io.BytesIO(content)).read()
                except Exception as e:  # noqa: BLE001 - whatever keeps the file from being read is reported
                    out.append((p, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["file", "error"])
    return listed.join(given, "uri", "left_anti").select("path", "content").mapInPandas(opened, "file string, error string")
