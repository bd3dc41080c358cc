"""Grading of inferred codes and per-technology statistics.

match_patents   J4 + J5 + A1  level per returned patent (2 A, 1 B, 0 none)
tech_counts     A2            n, A, B, none per technology (partial aggregation)
validate_tech   A3-A5 + K1    rates, verdict, confidence, expected codes
evidence        W4            first k returned patents per technology
verdict_rollup  A8            verdict counts, overall or per domain

Plan shape: the expected lists (one row per technology) are small; they are
broadcast behind a measured size bound, so the large inferred side is graded
where it lies and only numeric partial aggregates are shuffled. A hot
technology holding a third of all rows costs nothing extra: its rows are
graded in every input task and combined map-side before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (CONF_BASE, CONF_SLOPE, EVIDENCE_REASONING,
                      NOT_SUPPORTED, PARTIALLY_SUPPORTED, SUPPORTED)
from ..functions.codes import (expected_arrays, level_name, main_group, norm_code, normalise_codes, pattern_of,
                               prefixes_sql, star_of, with_best_level)
from ..functions.numeric import with_py_round
from .sizing import fits, materialise

KEYS = ["domain", "tech_name_raw"]
#: Pieces of a technology in a stream whose expected lists are too large to broadcast.
SALTS = 64


def with_match_arrays(resolved: DataFrame) -> DataFrame:
    """Precompute pattern arrays once per technology (small side)."""
    arrays = expected_arrays("expected_codes")
    return resolved.select(*KEYS, *[v.alias(k) for k, v in arrays.items()])


def match_patents(inferred: DataFrame, resolved: DataFrame,
                  star_prefix: bool = False, check_broadcast: bool = True,
                  broadcast: bool | None = None) -> DataFrame:
    """Add ``level`` (int) to every inferred row.

    ``inferred`` needs (domain, tech_name_raw, inferred_codes array<string>);
    a technology missing from ``resolved`` has an empty expected list.
    ``broadcast`` True/False skips the measurement when the caller already
    knows the size of ``resolved`` (e.g. measured once before a stream).
    Expected lists that are too large to broadcast are matched code by code
    (``match_by_code``), in a stream by salted lists.
    """
    if broadcast is None and check_broadcast:
        # the pattern arrays are derived from the expected codes (at most ~4x)
        broadcast = fits(resolved, growth=4)
    if broadcast is False and not inferred.isStreaming:
        return match_by_code(inferred, resolved, star_prefix)
    small = with_match_arrays(resolved)
    keys = list(KEYS)
    if broadcast:
        small = F.broadcast(small)
    elif broadcast is False:
        # a stream's rows cannot be staged and regrouped: a technology's rows are dealt over
        # SALTS pieces and its expected list is repeated for each
        keys.append("_salt")
        inferred = inferred.withColumn("_salt", F.pmod(F.xxhash64(*inferred.columns), F.lit(SALTS)))
        small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    empty = F.array().cast("array<string>")
    arr = ("exp_pats", "exp_slashed", "exp_groups", "exp_stars")
    graded = inferred.join(small, keys, "left").select(
        *[c for c in inferred.columns if c != "_salt"],
        *[F.coalesce(F.col(k), empty).alias(k) for k in arr])
    return with_best_level(graded, "inferred_codes", "level", star_prefix=star_prefix).drop(*arr)


def match_by_code(inferred: DataFrame, resolved: DataFrame, star_prefix: bool = False) -> DataFrame:
    """``match_patents`` for expected lists of any size: no list is held on a row.

    Both sides are exploded. A technology's distinct codes are graded once each:
    a code matches a pattern (A) if the pattern is the code or one of its prefixes
    that hold a '/', and an expected code's main group (B) by equality, so both are
    equi-joins that form no pair but matches. The codes' levels go back to the rows,
    which carry a number from the time they are staged, and the largest counts.
    """
    rows = materialise(inferred.withColumn("_row", F.monotonically_increasing_id()))
    code = [*KEYS, "code"]
    given = (rows.select("_row", *KEYS, F.explode(normalise_codes("inferred_codes")).alias("code"))
             .where(F.col("code") != ""))
    distinct = given.select(*code).distinct()
    expected = resolved.select(*KEYS, F.explode("expected_codes").alias("e")).select(
        *KEYS, F.coalesce(norm_code("e"), F.lit("")).alias("n"))
    expected = expected.select(*KEYS, pattern_of("n").alias("pattern"), main_group("n").alias("group"),
                               (star_of("n") & ~F.contains("n", F.lit("/"))).alias("star")).distinct()
    prefixes = F.expr(prefixes_sql("code"))
    exact = distinct.select(*code, F.explode(F.array_distinct(F.concat(
        F.array("code"), F.filter(prefixes, lambda p: F.contains(p, F.lit("/")))))).alias("pattern"))
    hits = exact.join(expected.select(*KEYS, "pattern").distinct(), [*KEYS, "pattern"], "left_semi").select(*code, F.lit(2).alias("level"))
    if star_prefix:
        starred = distinct.select(*code, F.explode(F.array_distinct(prefixes)).alias("pattern")).join(
            expected.where("star").select(*KEYS, "pattern").distinct(), [*KEYS, "pattern"], "left_semi")
        hits = hits.unionByName(starred.select(*code, F.lit(2).alias("level")))
    grouped = distinct.withColumn("group", main_group("code")).where(F.col("group") != "")
    near = grouped.join(expected.select(*KEYS, "group").distinct(), [*KEYS, "group"], "left_semi")
    levels = hits.unionByName(near.select(*code, F.lit(1).alias("level"))).groupBy(*code).agg(F.max("level").alias("level"))
    best = given.join(levels, code).groupBy("_row").agg(F.max("level").alias("level"))
    return rows.join(best, "_row", "left").select(*inferred.columns, F.coalesce("level", F.lit(0)).cast("int").alias("level"))


def tech_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_patents"),
        F.count_if(F.col("level") == 2).alias("hits_a"),
        F.count_if(F.col("level") == 1).alias("hits_b"),
        F.count_if(F.col("level") == 0).alias("hits_none"))


def validate_tech(matched: DataFrame, resolved: DataFrame,
                  tau_strong: float = 0.35, tau_min: float = 0.15) -> DataFrame:
    """One row per technology of ``resolved`` (n_patents 0 when nothing returned).

    ``resolved`` (one row per technology, from ``resolve_expected``) is the
    technology dimension; the per-technology counts are already hash
    partitioned on the keys by their aggregate, so the join adds no exchange
    on that side (and AQE broadcasts the counts when they are small).
    """
    return _rates(resolved.join(tech_counts(matched), KEYS, "left"), tau_strong, tau_min)


def validate_from_counts(counts: DataFrame, resolved: DataFrame,
                         tau_strong: float = 0.35, tau_min: float = 0.15) -> DataFrame:
    """A3-A5 on (domain, tech_name_raw, n_patents, hits_a, hits_b, hits_none)."""
    res = resolved.select(*KEYS, "resolution_tier", "expected_codes")
    return _rates(counts.join(res, KEYS, "left"), tau_strong, tau_min)


def _rates(t: DataFrame, tau_strong: float, tau_min: float) -> DataFrame:
    n = F.coalesce(F.col("n_patents"), F.lit(0).cast("long"))

    def rate(c):
        return F.when(n > 0, F.coalesce(F.col(c), F.lit(0)) / n).otherwise(F.lit(0.0))

    base = t.select(*KEYS, n.alias("n_patents"),
                    rate("hits_a").alias("ra"), rate("hits_b").alias("rb"),
                    rate("hits_none").alias("rn"),
                    F.coalesce(F.array_join("expected_codes", ";"), F.lit("")).alias("expected_codes"),
                    "resolution_tier")
    ab = F.col("ra") + F.col("rb")
    base = base.select("*", ab.alias("ab"),
                       (F.lit(CONF_BASE) + F.lit(CONF_SLOPE) * ab).alias("conf"))
    rounded = with_py_round(base, {"rate_A": ("ra", 4), "rate_B": ("rb", 4),
                                   "rate_none": ("rn", 4), "confidence": ("conf", 3)})
    return rounded.select(
        *KEYS,
        F.col("tech_name_raw").alias("tech_name_expected"),
        "n_patents",
        "rate_A",
        "rate_B",
        F.lit(0.0).alias("rate_C"),
        "rate_none",
        F.when(F.col("ab") >= F.lit(float(tau_strong)), F.lit(SUPPORTED))
         .when(F.col("ab") >= F.lit(float(tau_min)), F.lit(PARTIALLY_SUPPORTED))
         .otherwise(F.lit(NOT_SUPPORTED)).alias("verdict"),
        "confidence",
        "expected_codes",
        "resolution_tier")


def evidence(matched: DataFrame, order_cols: Sequence[str], k: int = 5) -> DataFrame:
    """The first ``k`` returned patents per technology, in response order.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    exchange, so at most k rows per technology and input task are shuffled.
    """
    w = Window.partitionBy(*KEYS).orderBy(*[F.col(c) for c in order_cols])
    return (matched.withColumn("rank", F.row_number().over(w))
                   .where(F.col("rank") <= k)
                   .select(*KEYS, F.col("rank").cast("long").alias("rank"),
                           F.col("patent_id").cast("string").alias("patent_id"),
                           level_name("level").alias("code_match_level"),
                           F.coalesce("inferred_codes", F.array().cast("array<string>"))
                            .alias("inferred_codes"),
                           F.array(F.lit(EVIDENCE_REASONING)).alias("reasoning")))


def evidence_samples(ev: DataFrame) -> DataFrame:
    """Nest evidence rows into one array per technology (at most k each)."""
    return ev.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("rank", "patent_id", "code_match_level",
                                             "inferred_codes", "reasoning")))
         .alias("evidence_samples"))


def verdict_rollup(results: DataFrame, by_domain: bool = False) -> DataFrame:
    """techs_total and counts per verdict, overall or per domain."""
    aggs = [F.count(F.lit(1)).alias("techs_total"),
            F.count_if(F.col("verdict") == SUPPORTED).alias("n_supported"),
            F.count_if(F.col("verdict") == PARTIALLY_SUPPORTED).alias("n_partially_supported"),
            F.count_if(F.col("verdict") == NOT_SUPPORTED).alias("n_not_supported")]
    if by_domain:
        return results.groupBy("domain").agg(*aggs)
    return results.agg(F.array_join(F.array_sort(F.collect_set("domain")), ";").alias("domains"),
                       *aggs)
