"""What was sent against what came back, per technology.

The statistics count the patents that the service returned, whether or not they
were sent (a model may omit, invent or repeat ids). ``coverage_report`` holds the two
multisets of ids against each other:

sent, returned   rows on either side
missing_ids      sent ids that never came back
unknown_ids      returned rows whose id was not sent
duplicates       returned rows beyond as many as were sent of their id

Both sides are one table of signed counts, combined before the exchange on
(technology, id) and again on the technology, so a technology with a third of all
rows is spread over its ids and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["domain", "tech_name_raw"]
COUNTS = ["sent", "returned", "missing_ids", "unknown_ids", "duplicates"]


def coverage_report(sent: DataFrame, returned: DataFrame, tech: DataFrame | None = None) -> DataFrame:
    """``sent`` and ``returned`` hold (domain, tech_name_raw, patent_id); a row per technology.

    ``tech``: the technologies to report, with zeros where they have no rows.
    """
    def side(df: DataFrame, s: int, r: int) -> DataFrame:
        return df.select(*KEYS, F.col("patent_id").cast("string").alias("patent_id"),
                         F.lit(s).cast("long").alias("s"), F.lit(r).cast("long").alias("r"))
    ids = side(sent, 1, 0).unionByName(side(returned, 0, 1)).groupBy(*KEYS, "patent_id").agg(
        F.sum("s").alias("s"), F.sum("r").alias("r"))
    out = ids.groupBy(*KEYS).agg(
        F.sum("s").alias("sent"), F.sum("r").alias("returned"),
        F.count_if((F.col("s") > 0) & (F.col("r") == 0)).alias("missing_ids"),
        F.sum(F.when(F.col("s") == 0, F.col("r")).otherwise(0)).alias("unknown_ids"),
        F.sum(F.when((F.col("s") > 0) & (F.col("r") > F.col("s")), F.col("r") - F.col("s")).otherwise(0)).alias("duplicates"))
    if tech is None:
        return out
    zero = F.lit(0).cast("long")
    return tech.select(*KEYS).distinct().join(out, KEYS, "left").select(
        *KEYS, *[F.coalesce(c, zero).alias(c) for c in COUNTS])
