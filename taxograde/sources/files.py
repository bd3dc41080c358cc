"""File listing, and the reader of CSV files that Spark's own reader cannot read.

Files are listed with the ``binaryFile`` source selecting only their paths (the
content is never read by the listing). ``read_records`` reads the files that
``csv_tables`` leaves over (not UTF-8, and the like): executor tasks open them
through ``pyarrow.fs`` (local, HDFS and object-store URIs) and parse them in
chunks with pandas. ``ord`` = file rank * 2^43 + record number.
"""

from __future__ import annotations

import codecs
import posixpath
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

RECORD_BITS = 43
CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 20_000


def list_files(spark: SparkSession, root: str, glob: str | None = "*.csv",
               recursive: bool = True) -> DataFrame:
    """(path, rel, uri) for every file under ``root``: ``rel`` relative to it, ``uri`` as a scan's metadata spells it."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if not path_exists(spark, root):  # a missing folder lists nothing; other failures are raised
        return spark.createDataFrame([], "path string, rel string, uri string")
    base = _uri_root(root)
    return reader.load(root).select("path", F.expr(f"substring(path, {len(base) + 2})").alias("rel"),
                                    F.col("_metadata.file_path").alias("uri"))


def _uri_root(root: str) -> str:
    """The listing's spelling of ``root`` (``file:/x`` for local paths)."""
    r = root.rstrip("/")
    if "://" in r or r.startswith("file:"):
        if r.startswith("file://"):
            r = "file:" + r[len("file://"):]
        return r
    return "file:" + posixpath.abspath(r)


def component_value(part: str) -> str:
    """A ``name=value`` directory (as Spark's partitionBy writes) stands for value."""
    return unquote(part.split("=", 1)[1]) if "=" in part else part


def stem(name: str) -> str:
    """Path(name).stem: drop the last suffix only."""
    base = name.rsplit("/", 1)[-1]
    if base.startswith(".") and base.count(".") == 1:
        return base
    return base.rsplit(".", 1)[0] if "." in base else base


def open_file(path: str):
    """A binary stream of ``path`` inside a task, on whatever filesystem holds it."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_stream("/" + path[len("file:"):].lstrip("/"))
    fs, p = pafs.FileSystem.from_uri(path)
    return fs.open_input_stream(p)


def charset(path: str) -> str:
    """UTF-8 when the whole file is valid UTF-8, else GB18030 (the original's fallback)."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    with open_file(path) as f:
        try:
            while chunk := f.read(CHUNK_BYTES):
                decoder.decode(chunk)
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            return "gb18030"
    return "utf-8-sig"


def frames(path: str, sep: str, encoding: str, rows: int = CHUNK_ROWS) -> Iterator[pd.DataFrame]:
    """The records of one file in chunks, all cells as strings, missing ones as None.

    The reader is the original's: it skips blank lines, also before the header,
    fills short records and raises on records with too many fields. A file
    without any line has no records.
    """
    try:
        with open_file(path) as f:
            for part in pd.read_csv(f, dtype=str, encoding=encoding, sep=sep, chunksize=rows,
                                    keep_default_na=False, na_values=[""]):
                yield part.astype(object).where(part.notna(), None)
    except pd.errors.EmptyDataError:
        return


def header(path: str, sep: str = ",") -> list[str]:
    for encoding in ("utf-8-sig", "gb18030"):
        try:
            with open_file(path) as f:
                return list(pd.read_csv(f, dtype=str, encoding=encoding, sep=sep, nrows=0).columns)
        except pd.errors.EmptyDataError:
            return []
        except UnicodeDecodeError:
            continue
    raise ValueError(f"{path} is neither UTF-8 nor GB18030")


def read_records(files: DataFrame, n_files: int, pick: Callable[[str, str], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``pick(path, encoding)`` for every file, with the other columns of ``files`` and ``ord``.

    One task reads a file front to back, once to find its charset and once for
    its records, and never holds more than a chunk of it. ``ord`` is the file's
    rank times 2^43 plus the record's number; a file with more records raises.
    """
    spark = files.sparkSession
    carried = [f for f in files.schema.fields if f.name not in ("path", "uri", "file_rank")]
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + ["ord long", schema])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                at = 0
                for part in pick(row.path, charset(row.path)):
                    if at + len(part) > 1 << RECORD_BITS:
                        raise ValueError(f"{row.path} has over 2^{RECORD_BITS} records")
                    part = part.reset_index(drop=True)
                    part.insert(0, "ord", row.file_rank * (1 << RECORD_BITS) + at + part.index)
                    for f in reversed(carried):
                        part.insert(0, f.name, getattr(row, f.name))
                    at += len(part)
                    yield part
    lanes = max(1, min(n_files, 4 * spark.sparkContext.defaultParallelism))
    return files.repartition(lanes, "path").mapInPandas(run, out)


def with_file_order(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Attach the file's (domain, tech, file_rank) and compute ``ord``."""
    return rows.join(files, "path").withColumn(
        "ord", F.col("file_rank") * F.lit(1 << RECORD_BITS) + F.col("_rec"))
