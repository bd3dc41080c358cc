"""Batching: automatic batch size (F8, A7, W3), batch assignment (W2),
request building (I1, P5) and the request key (F9).

A batch is at most ``batch_size`` patents (at most ``auto_batch_cap`` in auto
mode), so ``collect_list`` per (technology, batch) gathers a bounded group and a
hot technology spreads over many batch groups.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (AUTO_BATCH_SAMPLE, MAX_ABSTRACT_CHARS, MAX_TITLE_CHARS,
                      MIN_AUTO_BATCH, PER_BATCH_OVERHEAD_TOKENS, SAFETY_RATIO,
                      SYSTEM_OVERHEAD_TOKENS)
from ..functions.numeric import item_tokens
from .numbering import positions
from .patents import truncate_text

KEYS = ["domain", "tech_name_raw"]


def token_budget(context_limit: int) -> int:
    return max(0, int(context_limit * SAFETY_RATIO)
               - (SYSTEM_OVERHEAD_TOKENS + PER_BATCH_OVERHEAD_TOKENS))


def auto_batch_size(tech: DataFrame | None, patents: DataFrame, context_limit: int = 128_000,
                    cap: int = 60) -> DataFrame:
    """(domain, tech_name_raw, n_sample, avg_item_tokens, batch_size) per technology.

    The sample is the first 50 cleaned records in file order; row_number <= 50
    is planned with a partial group limit, so at most 50 rows per technology
    and task are shuffled. With ``tech`` every technology gets a row (one
    without records gets the minimum size); with ``tech=None`` only
    technologies that have records do, which is all that batching needs.
    """
    budget = token_budget(context_limit)
    w = Window.partitionBy(*KEYS).orderBy("ord")
    sample = (patents.withColumn("_rn", F.row_number().over(w))
                     .where(F.col("_rn") <= AUTO_BATCH_SAMPLE)
                     .withColumn("_tok", item_tokens(F.substring("title", 1, MAX_TITLE_CHARS),
                                                     F.substring("abstract", 1, MAX_ABSTRACT_CHARS))))
    stats = sample.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_sample"),
        F.greatest(F.lit(1).cast("long"),
                   F.floor(F.sum("_tok") / F.count(F.lit(1))).cast("long")).alias("avg_item_tokens"))
    if budget <= 0:
        size = F.lit(MIN_AUTO_BATCH).cast("long")
    else:
        size = F.when(F.col("n_sample").isNull(), F.lit(MIN_AUTO_BATCH).cast("long")).otherwise(
            F.greatest(F.lit(MIN_AUTO_BATCH).cast("long"),
                       F.least(F.lit(cap).cast("long"),
                               F.floor(F.lit(float(budget)) / F.col("avg_item_tokens")).cast("long"))))
    rows = stats if tech is None else tech.select(*KEYS).distinct().join(stats, KEYS, "left")
    return rows.select(*KEYS, F.coalesce("n_sample", F.lit(0).cast("long")).alias("n_sample"),
                       "avg_item_tokens", size.alias("batch_size"))


def assign_batches(patents: DataFrame, size: int | DataFrame, max_title: int = MAX_TITLE_CHARS,
                   max_abstract: int = MAX_ABSTRACT_CHARS) -> DataFrame:
    """Add ``pos`` (0-based, file order), ``batch_size`` and ``batch_idx`` (from 1).

    ``size`` is one batch size or a per-technology table with ``batch_size``
    (one row per technology, e.g. from ``auto_batch_size``), which is joined to
    the chunk offsets of the numbering, not to the patents. Title and abstract
    are cut to what a request may hold before they are first exchanged.
    """
    if {"title", "abstract"} <= set(patents.columns):
        patents = truncate_text(patents, max_title, max_abstract)
    if isinstance(size, int):
        numbered = positions(patents, KEYS, "ord", out="pos").withColumn("batch_size", F.lit(size).cast("long"))
    else:
        numbered = positions(patents, KEYS, "ord", out="pos", per_group=size.select(*KEYS, "batch_size"))
    return numbered.withColumn("batch_idx", (F.floor(F.col("pos") / F.col("batch_size")) + 1).cast("long"))


def hierarchy_json(domains: list[str], items: list | None = None) -> str:
    """The hierarchy object as compact JSON with sorted keys."""
    return json.dumps({"domains": list(domains), "items": list(items or [])},
                      ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def payload_column(hierarchy: str | None = None) -> Column:
    """the request's JSON, keys sorted, from domain, patents and tech_name_raw."""
    batch_json = F.to_json(F.struct(F.col("domain"), F.col("patents"), F.col("tech_name_raw")))
    hier = hierarchy if hierarchy is not None else hierarchy_json([])
    return F.concat(F.lit('{"patent_batches":['), batch_json, F.lit('],"techset_hierarchy":'), F.lit(hier), F.lit("}"))


def request_columns(df: DataFrame, hierarchy: str | None = None, model_id: str = "") -> DataFrame:
    """Add n_items, payload (JSON, keys sorted) and cache_key to rows holding
    (domain, tech_name_raw, batch_idx, [sub_start], [batch_size], patents)."""
    if "sub_start" not in df.columns:
        df = df.withColumn("sub_start", F.lit(0).cast("long"))
    payload = payload_column(hierarchy)
    key = F.md5(payload) if not model_id else F.md5(F.concat(F.lit(model_id + "\n"), payload))
    sized = ["batch_size"] if "batch_size" in df.columns else []
    return (df.select(*KEYS, "batch_idx", "sub_start", *sized,
                      F.size("patents").cast("long").alias("n_items"), "patents",
                      payload.alias("payload"))
              .withColumn("cache_key", key))


def build_batches(assigned: DataFrame, hierarchy: str | None = None, model_id: str = "",
                  max_title: int = MAX_TITLE_CHARS, max_abstract: int = MAX_ABSTRACT_CHARS) -> DataFrame:
    """One request row per (technology, batch).

    Returns (domain, tech_name_raw, batch_idx, sub_start, n_items, patents,
    payload, cache_key); ``payload`` is JSON with keys in sorted order,
    ``cache_key`` its MD5 (prefixed by ``model_id`` when one is given).
    """
    item = F.struct(F.col("pos"),
                    F.struct(F.substring("abstract", 1, max_abstract).alias("abstract"),
                             F.col("patent_id").cast("string").alias("patent_id"),
                             F.substring("title", 1, max_title).alias("title")).alias("p"))
    sized = ["batch_size"] if "batch_size" in assigned.columns else []
    grouped = assigned.groupBy(*KEYS, "batch_idx").agg(
        F.array_sort(F.collect_list(item)).alias("_items"), *[F.max(c).alias(c) for c in sized])
    return request_columns(
        grouped.select(*KEYS, "batch_idx", *sized, F.transform("_items", lambda x: x["p"]).alias("patents")),
        hierarchy, model_id)
