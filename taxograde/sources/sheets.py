"""Spreadsheet mapping tables (.xlsx): the first worksheet as rows of text.

A mapping workbook is one small file per domain. Files are read with the
``binaryFile`` source and decoded inside an executor task (``mapInPandas``),
one file per row of the listing; the driver only sees the header row of each
file, which it needs to choose the name and code columns (P6, P7).

Cells keep the text the workbook stores: shared, inline and formula strings as
written, numbers in their stored decimal form, booleans as True / False and
error cells as missing (every column is text, as for CSV files). Legacy binary
``.xls`` workbooks are not read.
"""

from __future__ import annotations

import io
import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"

ROWS_SCHEMA = "path string, rec long, cells array<string>"


def _q(tag: str, ns: str = _MAIN) -> str:
    return f"{{{ns}}}{tag}"


def _first_sheet(z: zipfile.ZipFile) -> str:
    """Archive member of the workbook's first worksheet."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find(f"{_q('sheets')}/{_q('sheet')}")
    rid = sheet.get(_q("id", _DOC_REL)) if sheet is not None else None
    if rid and "xl/_rels/workbook.xml.rels" in z.namelist():
        for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(_q("Relationship", _PKG_REL)):
            if rel.get("Id") == rid:
                target = rel.get("Target", "")
                return target.lstrip("/") if target.startswith("/") else \
                    posixpath.normpath(posixpath.join("xl", target))
    return "xl/worksheets/sheet1.xml"


def _text(el) -> str:
    """A string item: its text, rich-text runs concatenated."""
    return "".join(t.text or "" for t in el.iter(_q("t")))


def _column(ref: str) -> int:
    """'C7' -> 2."""
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + (ord(ch.upper()) - ord("A") + 1)
    return n - 1


def sheet_rows(data: bytes) -> list[list[str | None]]:
    """Rows of the first worksheet, each a list of cell texts (None = empty)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(_q("si"))]
        sheet = ET.fromstring(z.read(_first_sheet(z)))
    rows = []
    for row in sheet.iter(_q("row")):
        cells: dict[int, str | None] = {}
        col = -1
        for c in row.iter(_q("c")):
            ref = c.get("r")
            col = _column(ref) if ref else col + 1
            kind = c.get("t", "n")
            if kind == "inlineStr":
                inline = c.find(_q("is"))
                cells[col] = _text(inline) if inline is not None else None
                continue
            v = c.find(_q("v"))
            if v is None:
                continue
            val = v.text or ""
            if kind == "s":
                val = shared[int(val)]
            elif kind == "b":
                val = "True" if val.strip() == "1" else "False"
            elif kind == "e":
                val = None
            cells[col] = val
        rows.append([cells.get(j) for j in range(max(cells) + 1)] if cells else [])
    return rows


def read_sheet_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, rec, cells): rec 0 is the header row, then the data rows in order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                for i, cells in enumerate(sheet_rows(bytes(content))):
                    out.append((path, i, cells))
            yield pd.DataFrame(out, columns=["path", "rec", "cells"])
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(run, ROWS_SCHEMA)


def header_names(cells: list[str | None] | None) -> list[str]:
    """Column names as the original reader labels them: blank headers become
    'Unnamed: <position>', repeated names get '.1', '.2', ..."""
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(cells or []):
        name = c if c not in (None, "") else f"Unnamed: {i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        out.append(name)
    return out


def as_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """Data rows of files sharing a header, one string column per header name."""
    return rows.where(F.col("rec") > 0).select(
        "path", F.col("rec").alias("_rec"),
        *[F.get(F.col("cells"), i).alias(n) for i, n in enumerate(names)])
