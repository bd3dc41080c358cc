"""CSV files through Spark's own reader, a scan per group of equal headers.

One pass over the lines of all files (the text source, split like any other) finds
for every file whether it is UTF-8, whether a record may span lines (a line with an
odd number of quotes), and the largest number of fields of a line. A file's header
is its first line that is not blank. Then

- UTF-8 files whose records end with their lines are read with the splittable reader,
  only the needed columns; a line with more fields than the header raises before;
- UTF-8 files with records over several lines are read with ``multiLine`` (such a
  file is one task), and a corrupt-record column shows records with too many fields;
- other files (GB18030, and headers behind lines of spaces in files with records
  over several lines) are decoded by the reader of ``files.py``, a task a file.

Spark lists the files of a scan on the driver, so their paths are collected here as
well; their contents never are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import bounded_broadcast, materialise
from . import files as FS

_BLANK = r"^[ \t]*$"
_RAW = "_raw"
_ROW_BITS = 33


@dataclass
class Group:
    """Files with one separator and one header; ``multiline``: records may span lines."""
    sep: str
    names: list[str]
    multiline: bool
    paths: list[str] = field(default_factory=list)


def _fields(line: Column, sep: str) -> Column:
    """Number of fields of a line that starts and ends outside quotes."""
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _escaped(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def line_facts(spark: SparkSession, paths: Sequence[str], seps: Sequence[str]) -> DataFrame:
    """(uri, utf8, spans, late, fields array): one row per file that has a line, by one pass over the lines."""
    lines = spark.read.text([_escaped(p) for p in paths]).select(
        "value", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("m"))
    value = F.col("value")
    blank = value.rlike(_BLANK)
    odd = F.pmod(F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit(""))), F.lit(2)) == 1
    blocks = lines.groupBy("uri", "start").agg(
        F.min(F.is_valid_utf8(value)).alias("utf8"), F.max(odd).alias("spans"),
        F.min(F.when(~blank, F.col("m"))).alias("first"), F.min(F.when(value != "", F.col("m"))).alias("some"),
        *[F.max(F.when(~blank, _fields(value, s))).alias(f"fields{i}") for i, s in enumerate(seps)])
    late = F.min(F.when(F.col("start") == 0, F.col("some") < F.col("first")))
    return blocks.groupBy("uri").agg(
        F.min("utf8").alias("utf8"), F.max("spans").alias("spans"), F.coalesce(late, F.lit(False)).alias("late"),
        F.array(*[F.max(f"fields{i}") for i in range(len(seps))]).alias("fields"))


def _headers(files: DataFrame, seps: Sequence[str]) -> DataFrame:
    """(path, names array<array<string>>): the header of each file under each separator."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "names": [[FS.header(p, s) for s in seps] for p in batch["path"]]})
    lanes = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(lanes, "path").mapInPandas(run, "path string, names array<array<string>>")


def plan_groups(spark: SparkSession, files: DataFrame, seps: Sequence[str] = (",",)) -> tuple[list[Group], list[str]]:
    """The groups of ``files(path, uri)``, and the paths that Spark's reader cannot read as they are.

    The first separator under which no line has more fields than the header is a
    file's; a file whose lines have more under each raises. Files without a line
    are in no group.
    """
    paths = [r[0] for r in files.select("path").collect()]
    if not paths:
        return [], []
    known = files.select("path", "uri").join(line_facts(spark, paths, seps), "uri").join(_headers(files, seps), "path")
    groups: dict[tuple, Group] = {}
    others = []
    for r in known.select("path", "utf8", "spans", "late", "fields", "names").toLocalIterator():
        if not r["utf8"] or r["spans"] and (r["late"] or len(seps) > 1):
            others.append(r["path"])
            continue
        k = 0
        if not r["spans"]:
            fit = [i for i, n in enumerate(r["names"]) if r["fields"][i] <= len(n)]
            if not fit:
                raise ValueError(f"{r['path']}: Expected {len(r['names'][-1])} fields, saw {r['fields'][-1]}")
            k = fit[0]
        key = (seps[k], tuple(r["names"][k]), r["spans"])
        groups.setdefault(key, Group(seps[k], list(r["names"][k]), r["spans"])).paths.append(r["path"])
    return [groups[k] for k in sorted(groups)], sorted(others)


def read_group(spark: SparkSession, group: Group, columns: dict[str, str | None]) -> DataFrame:
    """(uri, rec, columns...): the records of a group; ``columns`` maps output names to header names (None: NULL).

    ``rec`` is the record's place in its file where the file is one split, else the
    split's place in bytes plus the record's place in the split: unique and in file order.
    """
    at = {name: i for i, name in reversed(list(enumerate(group.names)))}
    schema = ", ".join([f"c{i} string" for i in range(len(group.names))] + [f"{_RAW} string"] * group.multiline)
    reader = (spark.read.schema(schema).option("header", True).option("sep", group.sep).option("quote", '"')
              .option("escape", '"').option("maxColumns", len(group.names) + 20_480).option("multiLine", group.multiline))
    if group.multiline:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    raw = reader.csv([_escaped(p) for p in group.paths])
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    where = [F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"), row.alias("row")]
    # a task's partition may hold several files or splits: their first rows there, counted without parsing a field
    firsts = bounded_broadcast(materialise(raw.select(*where).groupBy("uri", "start").agg(F.min("row").alias("first"))))
    cells = {name: F.nullif(F.col(f"c{at[source]}"), F.lit("")) if source in at else F.lit(None).cast("string")
             for name, source in columns.items()}
    if group.multiline:
        n = len(group.names)
        fields = _fields(F.regexp_replace(_RAW, '""', ""), group.sep)
        bad = F.when(F.col(_RAW).isNotNull() & (fields > n),
                     F.raise_error(F.concat(F.lit(f"Expected {n} fields, saw "), fields.cast("string"))).cast("boolean"))
        rows = raw.select(*where, *[c.alias(k) for k, c in cells.items()], bad.alias("_bad"),
                          F.col(_RAW).rlike(r"^\s*$").alias("_blank"))
        rows = rows.where(F.col("_bad").isNull() & ~F.coalesce("_blank", F.lit(False))).drop("_bad", "_blank")
    else:
        rows = raw.select(*where, *[c.alias(k) for k, c in cells.items()])
    return (rows.join(firsts, ["uri", "start"])
            .withColumn("rec", F.col("start") + F.col("row") - F.col("first")).drop("start", "row", "first"))

