"""Expert mapping: column choice (P6, P7), items (P8, F5, A6), resolution.

``resolve_expected`` assigns every technology the codes of one mapping item:

tier 0  trimmed item name equals the trimmed technology name
tier 1  item name contains the (untrimmed) technology name or the reverse
tier 2  the first item of the domain
Within a tier the lowest item ``ord`` wins; a domain without items gives [].

No tier compares all technology/item pairs of a domain. Tiers 0 and 1 are
equi-joins of names to the other side's substrings (a name contained in
another is one of its substrings), so every joined pair is a match and nothing
is verified after the join. Tier 2 joins a one-row-per-domain table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CODE_KEYWORDS, NAME_KEYWORDS
from ..functions.codes import py_strip, tokenise_cell
from .sizing import fits, hint, materialise, materialise_parts

KEYS = ["domain", "tech_name_raw"]


def choose_name_column(columns: Sequence[str]) -> str:
    """The first column holding the earliest possible keyword, else the first column."""
    hits = ((k, i) for k, word in enumerate(NAME_KEYWORDS) for i, c in enumerate(columns) if word.lower() in c.lower())
    return columns[min(hits, default=(0, 0))[1]]


def choose_code_columns(columns: Sequence[str], name_col: str) -> list[str]:
    """Every header with a code keyword, else all but the name column."""
    coded = re.compile("|".join(map(re.escape, CODE_KEYWORDS)))
    return [c for c in columns if coded.search(c.lower())] or [c for c in columns if c != name_col]


def mapping_items(raw: DataFrame, name_col: str | None = None,
                  code_cols: Sequence[str] | None = None,
                  domain_col: str = "domain", ord_col: str = "ord") -> DataFrame:
    """P8 + F5 + A6 -> (domain, ord, tech_name, codes array<string>)."""
    data_cols = [c for c in raw.columns if c not in (domain_col, ord_col)]
    name_col = name_col or choose_name_column(data_cols)
    code_cols = list(code_cols or choose_code_columns(data_cols, name_col))
    name = py_strip(F.col(name_col).cast("string"))
    tokens = F.flatten(F.array(*[tokenise_cell(F.col(c).cast("string")) for c in code_cols])) \
        if code_cols else F.array().cast("array<string>")
    return (raw.select(F.col(domain_col).alias("domain"),
                       F.col(ord_col).cast("long").alias("ord"),
                       name.alias("tech_name"),
                       F.array_sort(F.array_distinct(tokens)).alias("codes"))
               .where(F.col("tech_name").isNotNull() & (F.col("tech_name") != "")
                      & (F.lower("tech_name") != "nan") & (F.size("codes") > 0)))


def items_from_cells(rows: DataFrame) -> DataFrame:
    """P8 + F5 + A6 for rows (domain, ord, tech_name, cells array<string>)."""
    tokens = F.flatten(F.transform("cells", tokenise_cell))
    return (rows.select("domain", "ord", py_strip(F.col("tech_name")).alias("tech_name"),
                        F.array_sort(F.array_distinct(tokens)).alias("codes"))
                .where(F.col("tech_name").isNotNull() & (F.col("tech_name") != "")
                       & (F.lower("tech_name") != "nan") & (F.size("codes") > 0)))


def _rank(tier: int | Column) -> Column:
    """What resolution minimises: the tier, then the item's place (any 64-bit integer)."""
    return F.struct((F.lit(tier) if isinstance(tier, int) else tier).cast("int").alias("tier"), F.col("ord"))


def _substrings(df: DataFrame, text: str, cols: Sequence[str], lengths: Sequence[int]) -> DataFrame:
    """(cols..., sub): every distinct substring of ``text`` with one of ``lengths``, once.

    A name contained in another one is one of the latter's substrings, so an
    equi-join of these to the names finds exactly the containments, each pair
    once: no pair is formed that is not a match. Only lengths that occur among
    the other side's names are cut, so a long cell gives a row per place and
    such length, not all n(n+1)/2 substrings.
    """
    t = F.col(text)
    n = F.length(t)
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda k: k <= n)
    subs = F.array_distinct(F.flatten(F.transform(
        fitting, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: t.substr(i, k)))))
    return df.where(n > 0).select(*cols, F.explode(subs).alias("sub"))


def _lengths(names: dict[str, DataFrame]) -> dict[str, list[int]]:
    """Distinct lengths of the non-empty names of each one-column table (few, whatever the number of names), in one job."""
    parts = [df.select(F.lit(k).alias("k"), F.length(df.columns[0]).alias("n")) for k, df in names.items()]
    found = reduce(DataFrame.unionByName, parts).distinct().collect()
    return {k: sorted(r["n"] for r in found if r["k"] == k and r["n"]) for k in names}


def resolve_expected(tech: DataFrame, items: DataFrame) -> DataFrame:
    """J1 -> (domain, tech_name_raw, item_ord, resolution_tier, expected_codes).

    ``tech`` holds (domain, tech_name_raw); ``items`` comes from
    ``mapping_items``. Both are dimension-sized but may be derived from large
    tables and each is used by several branches below, which Spark would scan
    separately: both are staged by one write in the shared folder (lineage
    cut, each part measured by the same job) and broadcast under the bound.

    Tiers 0 and 1 (item name inside the technology name) are one equi-join of
    the technology name's substrings to the item names: the trimmed name is
    such a substring, so an item equal to it is tier 0. Tier 1 the other way
    round joins the item names' substrings to the technology names. Every
    technology also gets its domain's first item (tier 2; tier 1 for the empty
    name, which is inside every name), or NULL when the domain has no items,
    so the minimum rank per technology covers every technology exactly once.
    The result (one row per technology) is staged too: every later step joins it.
    """
    both = (tech.select(*KEYS).distinct()
                .select(F.lit("tech").alias("kind"), "domain", F.col("tech_name_raw").alias("name"),
                        F.lit(None).cast("long").alias("ord"),
                        F.lit(None).cast("array<string>").alias("codes"))
                .unionByName(items.select(F.lit("item").alias("kind"), "domain",
                                          F.col("tech_name").alias("name"), "ord", "codes")))
    dims = materialise_parts(both, "kind", ["tech", "item"])
    t_small, it_small = fits(dims["tech"]), fits(dims["item"])
    t_all = dims["tech"].select("domain", F.col("name").alias("tech_name_raw"))
    it = dims["item"].select("domain", "ord", F.col("name").alias("tech_name"))

    lengths = _lengths({"item": it.select("tech_name"), "tech": t_all.select("tech_name_raw")})
    inside = (_substrings(t_all, "tech_name_raw", KEYS, lengths["item"])
              .join(hint(it.withColumnRenamed("tech_name", "sub"), it_small), ["domain", "sub"])
              .select(*KEYS, _rank(F.when(F.col("sub") == py_strip("tech_name_raw"), 0).otherwise(1)).alias("rank")))
    named = t_all.where(F.col("tech_name_raw") != "").withColumnRenamed("tech_name_raw", "sub")
    around = (_substrings(it, "tech_name", ["domain", "ord"], lengths["tech"])
              .join(hint(named, t_small), ["domain", "sub"])
              .select("domain", F.col("sub").alias("tech_name_raw"), _rank(1).alias("rank")))
    first = hint(it.groupBy("domain").agg(F.min("ord").alias("ord")), it_small)
    fallback = t_all.join(first, "domain", "left").select(
        *KEYS, F.when(F.col("ord").isNotNull(), _rank(F.when(F.col("tech_name_raw") == "", 1).otherwise(2))).alias("rank"))

    best = (inside.unionByName(around).unionByName(fallback)
                  .groupBy(*KEYS).agg(F.min("rank").alias("rank"))
                  .select(*KEYS, F.col("rank.ord").alias("item_ord"), F.col("rank.tier").alias("resolution_tier")))
    codes = hint(dims["item"].select("domain", F.col("ord").alias("item_ord"), "codes"), it_small)
    return materialise(
        best.join(codes, ["domain", "item_ord"], "left")
            .select(*KEYS, "item_ord", "resolution_tier",
                    F.coalesce(F.col("codes"), F.array().cast("array<string>"))
                     .alias("expected_codes")))
