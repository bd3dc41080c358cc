"""Broadcast only behind a measured size bound; materialise small derived sides.

``materialise`` writes a small side derived from large tables to a Parquet
table in the shared ``spark.checkpoint.dir`` folder and reads it back. That cuts
lineage (an executor loss does not replay the scan of the large table, and
later joins do not recompute it), and the same write job measures the table:
an ``observe`` on the written rows gives the row count and serialised size, so
no separate counting job is needed. The measurement travels with the returned
DataFrame.

``fits`` / ``bounded_broadcast`` use that measurement (or take one with a
single aggregate) and add the broadcast hint only under both limits. Beyond
them the plain DataFrame is returned, so the planner falls back to a shuffled
join (and AQE may still pick a broadcast from runtime statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import shared_path

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 128 * 1024 * 1024

_SIZE_ATTR = "_taxograde_size"


def _size_exprs(df: DataFrame):
    return (F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("bytes"))


def measure(df: DataFrame) -> tuple[int, int]:
    known = getattr(df, _SIZE_ATTR, None)
    if known is not None:
        return known
    row = df.agg(*_size_exprs(df)).first()
    return int(row["n"]), int(row["bytes"])


def fits(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
         max_bytes: int = DEFAULT_MAX_BYTES, growth: int = 1) -> bool:
    """True when ``df`` (times ``growth`` for derived columns) is under both limits."""
    rows, size = measure(df)
    return rows <= max_rows and size * growth <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def hint(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast ``df`` when a measurement of it (or of a superset) fit."""
    return F.broadcast(df) if small else df


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder, read back, and remember the measured size.

    A DataFrame that is itself such a read-back (it carries a measurement) is
    returned as it is: it has no lineage left to cut.
    """
    if getattr(df, _SIZE_ATTR, None) is not None:
        return df
    spark = df.sparkSession
    path = shared_path(spark, "stage")
    obs = Observation()
    df.observe(obs, *_size_exprs(df)).write.parquet(path)
    out = spark.read.parquet(path)
    m = obs.get
    setattr(out, _SIZE_ATTR, (int(m.get("n") or 0), int(m.get("bytes") or 0)))
    return out


def materialise_parts(df: DataFrame, col: str, values: list[str]) -> dict[str, DataFrame]:
    """Stage several small tables in one write, partitioned by ``col``.

    Returns one DataFrame per value of ``col`` (read with partition pruning),
    each carrying its own measurement taken by the same write job.
    """
    spark = df.sparkSession
    path = shared_path(spark, "stage")
    obs = Observation()
    width = F.length(F.to_json(F.struct(*df.columns)))
    exprs = []
    for k, v in enumerate(values):
        hit = F.col(col) == F.lit(v)
        exprs += [F.count_if(hit).alias(f"n{k}"),
                  F.coalesce(F.sum(F.when(hit, width)), F.lit(0)).alias(f"b{k}")]
    df.observe(obs, *exprs).write.partitionBy(col).parquet(path)
    m = obs.get
    out = {}
    for k, v in enumerate(values):
        part = spark.read.parquet(path).where(F.col(col) == F.lit(v)).drop(col)
        setattr(part, _SIZE_ATTR, (int(m.get(f"n{k}") or 0), int(m.get(f"b{k}") or 0)))
        out[v] = part
    return out
