"""Patent cleaning: null tokens, P1 fill, P4 empty-row filter, P5 truncation, W1 ids.

Input: (domain, tech_name_raw, ord, [id], title, abstract) with ``ord`` the
row position inside its file. Output keeps ``ord`` so later operators can
number and batch rows in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAX_ABSTRACT_CHARS, MAX_TITLE_CHARS, NULL_TOKENS
from .numbering import positions

KEYS = ["domain", "tech_name_raw"]


def null_tokens(col) -> Column:
    """Cells the original CSV reader treats as missing become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def clean_patents(raw: DataFrame, title_col: str = "title", abstract_col: str = "abstract",
                  id_col: str | None = "patent_id") -> DataFrame:
    """P1 + P4 (+ W1 for rows without an id column).

    Returns (domain, tech_name_raw, ord, patent_id, title, abstract). Rows come
    from files with an id column when ``id_col`` exists in ``raw`` (a boolean
    ``has_id`` column, when present, says so per file). A missing id cell gives
    'nan', as str() of a missing value did.
    """
    title = F.coalesce(null_tokens(F.col(title_col).cast("string")), F.lit(""))
    abstract = F.coalesce(null_tokens(F.col(abstract_col).cast("string")), F.lit(""))
    present = id_col is not None and id_col in raw.columns
    has_id = F.col("has_id") if "has_id" in raw.columns else F.lit(present)
    ident = (F.coalesce(null_tokens(F.col(id_col).cast("string")), F.lit("nan"))
             if present else F.lit(None).cast("string"))
    kept = raw.select(*KEYS, F.col("ord").cast("long").alias("ord"), has_id.alias("_has_id"),
                      ident.alias("patent_id"), title.alias("title"), abstract.alias("abstract")) \
              .where((F.col("title") != "") | (F.col("abstract") != ""))
    cols = [*KEYS, "ord", "patent_id", "title", "abstract"]
    if present and "has_id" not in raw.columns:
        return kept.select(*cols)
    with_ids = kept.where(F.col("_has_id")).select(*cols)
    without = synthetic_ids(kept.where(~F.col("_has_id")).drop("patent_id")).select(*cols)
    return with_ids.unionByName(without)


def synthetic_ids(cleaned: DataFrame) -> DataFrame:
    """W1: '{tech}-{i}', i counting from 0 in file order after the filter."""
    numbered = positions(cleaned, KEYS, "ord", out="_i")
    return numbered.withColumn(
        "patent_id", F.concat(F.col("tech_name_raw"), F.lit("-"), F.col("_i").cast("string"))
    ).drop("_i")


def truncate_text(df: DataFrame, max_title: int = MAX_TITLE_CHARS,
                  max_abstract: int = MAX_ABSTRACT_CHARS) -> DataFrame:
    """P5: keep the first code points of title and abstract."""
    return (df.withColumn("title", F.substring("title", 1, max_title))
              .withColumn("abstract", F.substring("abstract", 1, max_abstract)))
