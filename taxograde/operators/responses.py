"""Responses: parse raw text (N1, N2) and flatten to patents.

Parsing runs on the built-in VARIANT parser, for plain, fenced and prose-wrapped
objects; in a text it cannot read like that (broken, or several objects) a fold
over its braces finds the first object that parses. No row leaves the JVM.

Flattening keeps the reference's order: batch index, position of the batch in
the response, position of the patent in the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FENCE_PATTERN
from ..functions.codes import py_strip
from ..functions.json_text import first_object

KEYS = ["domain", "tech_name_raw"]
FENCE_REGEX = "(?iU)" + FENCE_PATTERN
# Prose before an object: not a JSON array, string, number or literal on its own.
# A JSON array, string, number or literal on its own.
OTHER_JSON_REGEX = r'(?s)^(?:\[.*\]|".*"|-?\d[\d.eE+-]*|true|false|null)$'
PROSE_REGEX = r"^(?!(?:true|false|null)$)[^\[\"0-9{-]"


def parse_responses(responses: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Add ``response`` (VARIANT object or NULL) and ``parse_status``.

    parse_status: 'ok' (object with patent_batches), 'no_batches' (JSON without
    it: an empty result) or 'error' (no JSON object found). Each text is parsed
    once by the built-in parser; a text starting with '{' that parses is an
    object, and a path lookup on anything else is NULL, so no schema walk of
    the (possibly large) answer is needed.
    """
    stripped = F.col("_text")
    # an answer wrapped in prose is read from its first brace to its last one
    wrapped = F.when(stripped.rlike(PROSE_REGEX), F.regexp_extract(stripped, r"(?s)\{.*\}", 0))
    whole = stripped.rlike(OTHER_JSON_REGEX)
    df = responses.withColumn("_text", F.regexp_replace(py_strip(F.col(text_col)), FENCE_REGEX, ""))
    df = df.withColumn("_parsed", F.coalesce(
        F.when(stripped.startswith("{"), F.try_parse_json(stripped)).otherwise(F.try_parse_json(F.nullif(wrapped, F.lit("")))),
        F.when(whole, F.try_parse_json(stripped)),
        F.try_parse_json(first_object("_text"))))
    df = df.withColumn("_batches", F.try_variant_get("_parsed", "$.patent_batches", "variant"))
    return (df.withColumn("response", F.when(F.col("_batches").isNotNull(), F.col("_parsed")))
              .withColumn("parse_status",
                          F.when(F.col("_parsed").isNull(), F.lit("error"))
                           .when(F.col("_batches").isNotNull(), F.lit("ok"))
                           .otherwise(F.lit("no_batches")))
              .drop("_text", "_parsed", "_batches"))


def _as_text(v: Column, missing: str) -> Column:
    """str() of a JSON value as Python would print it; ``missing`` when absent."""
    kind = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(missing))
             .when(kind == "STRING", F.variant_get(v, "$", "string"))
             .when(kind == "VOID", F.lit("None"))
             .when(kind == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), "True").otherwise("False"))
             .otherwise(F.to_json(v)))


def _string_or_null(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))


def merge_responses(parsed: DataFrame, order_col: str = "batch_idx") -> DataFrame:
    """Flatten to (domain, tech_name_raw, batch_idx, sub_start, bpos, ppos, patent_id,
    inferred_codes); response order is (batch_idx, sub_start, bpos, ppos).

    Only batches whose echoed domain and technology equal the request's are
    kept. A code that is not a JSON string becomes NULL (it can never match);
    a non-array ``inferred_codes`` counts as no codes.
    """
    sub = F.col("sub_start") if "sub_start" in parsed.columns else F.lit(0).cast("long")
    batches = parsed.where(F.col("parse_status") == "ok").select(
        *KEYS, F.col(order_col).alias("batch_idx"), sub.alias("sub_start"),
        F.posexplode(F.try_variant_get("response", "$.patent_batches", "array<variant>"))
         .alias("bpos", "b"))
    same = (_string_or_null(F.try_variant_get("b", "$.domain", "variant")) == F.col("domain")) & \
           (_string_or_null(F.try_variant_get("b", "$.tech_name_raw", "variant")) == F.col("tech_name_raw"))
    patents = batches.where(same).select(
        *KEYS, "batch_idx", "sub_start", F.col("bpos").cast("int").alias("bpos"),
        F.posexplode(F.try_variant_get("b", "$.patents", "array<variant>")).alias("ppos", "p"))
    codes = F.try_variant_get("p", "$.inferred_codes", "array<variant>")
    return patents.select(
        *KEYS, "batch_idx", "sub_start", "bpos", F.col("ppos").cast("int").alias("ppos"),
        _as_text(F.try_variant_get("p", "$.patent_id", "variant"), "").alias("patent_id"),
        F.coalesce(F.transform(codes, _string_or_null),
                   F.array().cast("array<string>")).alias("inferred_codes"))
