"""Typed inputs: hierarchy (S1), mapping files (S2-S4), patent files.

File lists are tables: the listing runs as a Spark job. CSV files are read by
``csv_tables``; workbooks and files that are not UTF-8 by tasks that open them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_DOMAINS
from ..operators.sizing import bounded_broadcast, materialise, measure
from . import csv_tables as CT
from . import files as FS
from . import sheets as SH

KEYS = ["domain", "tech_name_raw"]
MAPPING_SUFFIXES = [".xlsx", ".xls", ".csv"]


@dataclass
class Techset:
    domains: list[str]
    items: list
    text: str  # compact JSON with sorted keys, as sent with every request

    def domains_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i + 1, d) for i, d in enumerate(self.domains)],
                                     "domain_pos long, domain string")


def read_techset(spark: SparkSession, path: str) -> Techset:
    """S1. A missing file raises; missing ``domains`` gives the default four."""
    found = spark.read.text(path, wholetext=True).limit(2).collect()  # one configuration file
    if not found:
        raise FileNotFoundError(path)
    if len(found) > 1:
        raise ValueError("hierarchy must be one JSON file")
    obj = json.loads(found[0]["value"])
    domains = obj.get("domains", DEFAULT_DOMAINS)
    items = obj.get("items", [])
    text = json.dumps({"domains": domains, "items": items}, ensure_ascii=False,
                      sort_keys=True, separators=(",", ":"))
    return Techset(list(domains), list(items), text)


def techset_frames(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1 as DataFrames: (domain_pos, domain) and (domain, technology)."""
    raw = spark.read.option("multiLine", True).json(path)
    if "domains" in raw.columns:
        doms = raw.select(F.posexplode("domains").alias("p", "domain")) \
                  .select((F.col("p") + 1).cast("long").alias("domain_pos"), "domain")
    else:
        doms = spark.createDataFrame([(i + 1, d) for i, d in enumerate(DEFAULT_DOMAINS)],
                                     "domain_pos long, domain string")
    if "items" in raw.columns:
        items = raw.select(F.explode("items").alias("it")).select(
            F.col("it.domain").alias("domain"), F.explode_outer("it.technologies").alias("technology"))
    else:
        items = spark.createDataFrame([], "domain string, technology string")
    return doms, items


# ------------------------------------------------------------------ mapping ---

def _component_value(c):
    """Spark-side ``files.component_value``: ``key=value`` stands for value."""
    return F.when(F.instr(c, "=") > 0,
                  F.try_url_decode(F.replace(F.substring_index(c, "=", -1), F.lit("+"), F.lit("%2B")))
                  ).otherwise(c)


def detect_mapping(spark: SparkSession, mappings_dir: str, domains: DataFrame) -> DataFrame:
    """(domain, name, paths, uris) of the chosen mapping file per domain.

    Ranks: {d}.xlsx, {d}.xls, {d}.csv, {d}*.xlsx, {d}*.xls, {d}*.csv; ties in a
    wildcard rank go to the smallest name (deterministic). A folder of part
    files named like a file (as Spark writes, also ``key=name``) is one file.
    Files are joined to domains on their name prefixes, never on all pairs.
    """
    listing = FS.list_files(spark, mappings_dir, glob=None, recursive=True)
    logical = listing.select("path", "uri", _component_value(F.split_part("rel", F.lit("/"), F.lit(1))).alias("name"))
    files = logical.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("path", "uri"))).alias("files"))
    prefixes = files.select("name", "files", F.explode(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1))),
                    lambda i: F.substring("name", 1, i))).alias("domain"))
    rest = F.expr("substring(name, length(domain) + 1)")
    rank = F.lit(None).cast("int")
    for i, suf in reversed(list(enumerate(MAPPING_SUFFIXES))):
        rank = F.when(rest == suf, F.lit(i)).otherwise(rank)
    for i, suf in reversed(list(enumerate(MAPPING_SUFFIXES))):
        rank = F.when(rank.isNull() & F.col("name").endswith(suf), F.lit(3 + i)).otherwise(rank)
    cand = prefixes.join(domains.select("domain"), "domain").withColumn("rank", rank) \
                   .where(F.col("rank").isNotNull())
    best = cand.groupBy("domain").agg(F.min(F.struct("rank", "name", "files")).alias("b"))
    return best.select("domain", F.col("b.name").alias("name"), F.col("b.files.path").alias("paths"),
                       F.col("b.files.uri").alias("uris"))


def _mapping_records(seps: Sequence[str]):
    """Records (tech_name, cells) of a mapping file; the first separator that parses all of it."""
    from ..operators.mapping import choose_code_columns, choose_name_column

    def pick(path: str, encoding: str) -> Iterator[pd.DataFrame]:
        for sep in seps:
            try:
                for _ in FS.frames(path, sep, encoding):
                    pass
                break
            except (pd.errors.ParserError, UnicodeDecodeError):
                if sep == seps[-1]:
                    raise
        for part in FS.frames(path, sep, encoding):
            names = [str(c) for c in part.columns]
            part.columns = names
            name = choose_name_column(names)
            codes = choose_code_columns(names, name)
            yield pd.DataFrame({"tech_name": part[name], "cells": part[codes].to_numpy().tolist()})
    return pick


def _ord(rec) -> Column:
    """File order inside a technology or domain: the file's rank, then the record's place."""
    return (F.col("file_rank") * F.lit(1 << FS.RECORD_BITS) + rec).alias("ord")


def read_mapping_items(spark: SparkSession, chosen: DataFrame, seps: Sequence[str] = (",", ";")) -> DataFrame:
    """S3/S4 + P6-P8: mapping items (domain, ord, tech_name, codes) from CSV and
    .xlsx files.

    Name and code columns are chosen from each file's own header. A CSV file
    that does not parse with the first separator is read with the next one. A
    cell the original reader treats as missing (empty, NA, null, ...) gives no
    code and no name. A domain without a file has no items. Legacy .xls
    workbooks raise.
    """
    from ..operators.mapping import choose_code_columns, choose_name_column, items_from_cells, mapping_items
    from ..operators.patents import null_tokens
    picks = [(r["domain"], r["name"]) for r in chosen.select("domain", "name").collect()]  # one per domain
    legacy = sorted({n for _, n in picks if n.lower().endswith(".xls")})
    if legacy:
        raise NotImplementedError("legacy .xls mappings: save them as .xlsx or .csv: "
                                  + ", ".join(legacy))
    out = spark.createDataFrame([], "domain string, ord long, tech_name string, codes array<string>")
    parts = chosen.select("domain", F.lower("name").alias("name"),
                          F.posexplode(F.arrays_zip("paths", "uris")).alias("file_rank", "file"))
    parts = parts.select("domain", "name", F.col("file_rank").cast("long").alias("file_rank"),
                         F.col("file.paths").alias("path"), F.col("file.uris").alias("uri"))
    csvs = materialise(parts.where(F.col("name").endswith(".csv")).select("path", "uri", "domain", "file_rank"))
    groups, others = CT.plan_groups(spark, csvs, seps)
    for g in groups:
        name = choose_name_column(g.names)
        codes = choose_code_columns(g.names, name)
        rows = CT.read_group(spark, g, {"tech_name": name, **{f"code{i}": c for i, c in enumerate(codes)}})
        rows = rows.join(bounded_broadcast(csvs), "uri").select(
            "domain", _ord(F.col("rec")), null_tokens(F.col("tech_name")).alias("tech_name"),
            F.array(*[null_tokens(F.col(f"code{i}")) for i in range(len(codes))]).cast("array<string>").alias("cells"))
        out = out.unionByName(items_from_cells(rows))
    if others:
        rows = FS.read_records(csvs.where(F.col("path").isin(others)), len(others), _mapping_records(tuple(seps)),
                               "tech_name string, cells array<string>")
        out = out.unionByName(items_from_cells(rows.select(
            "domain", "ord", null_tokens(F.col("tech_name")).alias("tech_name"),
            F.transform("cells", null_tokens).alias("cells"))))
    books = [(r["path"], r["domain"], r["file_rank"]) for r in parts.where(F.col("name").endswith(".xlsx")).collect()]
    if books:
        files = F.broadcast(spark.createDataFrame(books, "path string, domain string, file_rank long"))  # one per domain
        rows = SH.read_sheet_rows(spark, [p for p, _, _ in books])
        headers: dict[tuple[str, ...], list[str]] = {}
        for r in rows.where(F.col("rec") == 0).select("path", "cells").collect():
            headers.setdefault(tuple(SH.header_names(r["cells"])), []).append(r["path"])
        for names, paths in sorted(headers.items()):
            if not names:
                continue
            df = FS.with_file_order(SH.as_columns(rows.where(F.col("path").isin(paths)), list(names)), files)
            name_col = choose_name_column(names)
            out = out.unionByName(mapping_items(
                df.select("domain", "ord", *[null_tokens(F.col(f"`{n}`")).alias(n) for n in names]),
                name_col=name_col, code_cols=choose_code_columns(names, name_col)))
    return out


# ------------------------------------------------------------------ patents ---

@dataclass
class PatentFiles:
    tech: DataFrame            # (domain, tech_name_raw) for every file, empty ones too
    rows: DataFrame | None     # (domain, tech_name_raw, ord, has_id, id, title, abstract)
    missing_domains: list[str]


def _patent_files(listing: DataFrame, domains: list[str]) -> DataFrame:
    """(path, uri, domain, tech_name_raw, file_rank) of the listed files that belong to a domain.

    ``<domain>/<tech>.csv`` is a file; a folder of that name stands for one file
    of several parts, ranked by path.
    """
    part = lambda k: F.split_part("rel", F.lit("/"), F.lit(k))
    tech = _component_value(part(2))
    files = listing.where(F.instr("rel", "/") > 0).select(
        "path", "uri", _component_value(part(1)).alias("domain"), tech.alias("tech_file"), (part(3) == "").alias("flat"))
    files = files.where(F.col("domain").isin(list(domains)) & (F.col("flat") | F.lower("tech_file").endswith(".csv")))
    w = Window.partitionBy(*KEYS).orderBy("path")
    return (files.select("path", "uri", "domain", F.regexp_replace("tech_file", r"(?s)^(.+)\.[^.]*$", "$1").alias("tech_name_raw"))
            .withColumn("file_rank", (F.row_number().over(w) - 1).cast("long")))


def patent_files(spark: SparkSession, patents_dir: str, domains: list[str]) -> DataFrame:
    """The files of all technologies: (path, uri, domain, tech_name_raw, file_rank), staged."""
    return materialise(_patent_files(FS.list_files(spark, patents_dir, "*.csv", recursive=True), domains))


def read_patents(spark: SparkSession, patents_dir: str, domains: list[str],
                 id_col: str = "patent id", title_col: str = "title",
                 abstract_col: str = "abstract", files: DataFrame | None = None) -> PatentFiles:
    """S5 + S6. A file lacking the title or abstract column raises (as the original).

    ``files`` (of ``patent_files``) restricts reading to some of them. Files of one
    header are one scan of Spark's CSV reader (``csv_tables``); ``ord`` orders the
    records of a technology: file rank * 2^43 + the record's place in the file.
    """
    files = patent_files(spark, patents_dir, domains) if files is None else materialise(files)
    tech = files.select(*KEYS).distinct()
    found = {r[0] for r in files.select("domain").distinct().collect()}
    missing = [d for d in domains if d not in found]
    groups, others = CT.plan_groups(spark, files)
    for g in groups:
        for c in [title_col, abstract_col]:
            if c not in g.names:
                raise ValueError(f"{min(g.paths)} is missing column: {c}")
    columns = ["domain", "tech_name_raw", "ord", "has_id", "patent_id", "title", "abstract"]
    out = None
    for g in groups:
        rows = CT.read_group(spark, g, {"patent_id": id_col if id_col in g.names else None,
                                        "title": title_col, "abstract": abstract_col})
        rows = rows.join(bounded_broadcast(files), "uri").select(
            *KEYS, _ord(F.col("rec")), F.lit(id_col in g.names).alias("has_id"), "patent_id", "title", "abstract")
        out = rows if out is None else out.unionByName(rows)
    if others:
        def pick(path: str, encoding: str) -> Iterator[pd.DataFrame]:
            for part in FS.frames(path, ",", encoding):
                for c in [title_col, abstract_col]:
                    if c not in part.columns:
                        raise ValueError(f"{path} is missing column: {c}")
                given = id_col in part.columns
                yield pd.DataFrame({"has_id": given, "patent_id": part[id_col] if given else None,
                                    "title": part[title_col], "abstract": part[abstract_col]})
        rows = FS.read_records(files.where(F.col("path").isin(others)), len(others), pick,
                               "has_id boolean, patent_id string, title string, abstract string")
        out = rows.select(*columns) if out is None else out.unionByName(rows.select(*columns))
    if out is None and measure(files)[0]:
        out = spark.createDataFrame([], "domain string, tech_name_raw string, ord long, has_id boolean, "
                                        "patent_id string, title string, abstract string")
    return PatentFiles(tech, out, missing)
