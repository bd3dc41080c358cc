"""Dense positions inside groups without one task per group.

``row_number().over(partitionBy(group).orderBy(ord))`` sends a whole group to
one task; a technology holding a third of all patents would then be sorted by
a single core. Instead:

1. cut each group into chunks of ``chunk`` consecutive ``ord`` values
   (``ord`` is unique inside a group, so a chunk holds at most ``chunk`` rows);
2. count rows per (group, chunk) - a small table, partially aggregated;
3. running sum over that table gives each chunk's offset;
4. number rows inside (group, chunk) and add the offset.

The join on (group, chunk) and the window on the same columns share one
hash exchange of the large side, and every window task holds at most
``chunk`` rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 16


def positions(df: DataFrame, keys: Sequence[str], order_col: str,
              out: str = "pos", chunk: int = DEFAULT_CHUNK, per_group: DataFrame | None = None) -> DataFrame:
    """Add ``out``: 0-based position of each row inside its group by ``order_col``.

    ``per_group`` (one row per group) is joined too, to the small table of chunk
    offsets, so that the rows are never exchanged on the group alone; rows of a
    group that it lacks are dropped.
    """
    keys = list(keys)
    tagged = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk)).cast("long"))
    counts = tagged.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_chunk") \
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(*keys, "_chunk",
                            (F.sum("_n").over(running) - F.col("_n")).alias("_offset"))
    if per_group is not None:
        offsets = offsets.join(per_group, keys)
    local = Window.partitionBy(*keys, "_chunk").orderBy(order_col)
    return (tagged.join(offsets, [*keys, "_chunk"])
                  .withColumn(out, F.col("_offset") + F.row_number().over(local) - 1)
                  .drop("_chunk", "_offset"))
