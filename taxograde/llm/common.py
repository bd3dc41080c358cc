"""Helpers shared by the operators of this subpackage.

``Scratch`` stages tables in the shared checkpoint folder (lineage cut that
survives lost executors) and deletes them again; ``salted_join`` joins a
one-row-per-key table to rows whose keys may be hot; ``components`` contracts a
link table to connected components without bringing links to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir, shared_path, ship_package

#: Keys salted by ``salted_join``: only the most frequent keys are spread, so the
#: broadcast list of them has at most this many rows whatever the data.
MAX_HOT_KEYS = 1024


#: Rows of an Arrow batch where the session has Spark's default: whole texts are large rows.
BATCH_ROWS = "1000"
_ROWS_SETTING, _DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def prepared(spark: SparkSession) -> SparkSession:
    """Ship the package to Python workers, settle the shared folder and the size of batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(_ROWS_SETTING) == _DEFAULT_ROWS:
        spark.conf.set(_ROWS_SETTING, BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Staged tables of one operator run, under ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        prepared(spark)
        self.spark = spark
        self.base = shared_path(spark, "llm", name)
        self.paths: list[str] = []
        self.staged = 0

    def path(self, name: str) -> str:
        out = f"{self.base}/{self.staged}-{name}"
        self.staged += 1
        self.paths.append(out)
        return out

    def stage(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = self.path(name)
        schema = df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def clear(self) -> None:
        """Delete what was staged; call it once nothing lazy still reads it."""
        delete_path(self.spark, self.base)

    def keep(self, *names: str) -> None:
        """Delete what was staged under other names; call it once nothing lazy still reads that."""
        self._delete(lambda name: name not in names)

    def drop(self, *names: str) -> None:
        """Delete what was staged under these names; call it once nothing lazy still reads that."""
        self._delete(lambda name: name in names)

    def _delete(self, chosen) -> None:
        gone = [p for p in self.paths if chosen(p.rsplit("/", 1)[-1].split("-", 1)[1])]
        for path in gone:
            delete_path(self.spark, path)
        self.paths = [p for p in self.paths if p not in gone]


def hot_keys(rows: DataFrame, key: str, per: int) -> list[tuple]:
    """(key, pieces) of the most frequent keys with more than ``per`` rows.

    At most MAX_HOT_KEYS: a key beyond them holds under 1/MAX_HOT_KEYS of the rows.
    """
    return hottest(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, per)


def hottest(sizes: DataFrame, key: str, per: int) -> list[tuple]:
    """``hot_keys`` of rows whose numbers ``n`` per key are known."""
    top = sizes.where(F.col("n") > per).orderBy(F.desc("n"), key).limit(MAX_HOT_KEYS).collect()
    return [(r[key], -(-r["n"] // per)) for r in top]


def salted_join(rows: DataFrame, one: DataFrame, key: str, salt: Column, how: str = "inner",
                per: int = 2000, counted: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Join ``one`` (a row per ``key``) to ``rows``, spreading hot keys of ``rows``.

    Rows of a hot key are dealt over ceil(n / per) pieces by ``salt`` (an integer
    expression over ``rows``, deterministic so that retried tasks deal alike) and
    the key's row of ``one`` is repeated once per piece. Nothing is dropped.
    ``how``: inner, left, left_anti or left_semi. ``counted`` has the keys of
    ``rows`` where they are cheaper to count than in ``rows`` itself; ``sizes`` has each
    key and the number ``n`` of its rows where that is known.
    """
    hot = hot_keys(rows if counted is None else counted, key, per) if sizes is None else hottest(sizes, key, per)
    if not hot:
        return rows.join(one, key, how)
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    pieces = F.broadcast(spark.createDataFrame(hot, f"`{key}` {kind}, _pieces long"))
    left = (rows.withColumn("_salt_by", salt).join(pieces, key, "left")
            .withColumn("_piece", F.when(F.col("_pieces").isNull(), F.lit(0).cast("long"))
                        .otherwise(F.pmod(F.col("_salt_by").cast("long"), F.col("_pieces"))))
            .drop("_salt_by", "_pieces"))
    right = (one.join(pieces, key, "left")
             .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        F.coalesce("_pieces", F.lit(1).cast("long")) - 1)))
             .drop("_pieces"))
    return left.join(right, [key, "_piece"], how).drop("_piece")


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)``: one row (node, label) per linked node.

    The label is the smallest node of the component. In each round a node takes
    the smallest label among its own, its neighbours', and that of the node its
    label names (which doubles the reach), one job per round over staged tables;
    labels only fall, so an unchanged sum of labels is the end. A star takes one
    round and a check. The joins on hot nodes are plain one-row-per-key joins,
    which adaptive execution splits.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = scratch.stage(both.where("node != other").distinct(), "ends")
    label = both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    label, last = _summed(scratch, label)
    while True:
        sent = both.join(label, "node").select(F.col("other").alias("node"), "label")
        near = sent.unionByName(label).groupBy("node").agg(F.min("label").alias("near"))
        far = label.select(F.col("node").alias("near"), F.col("label").alias("far"))
        label, now = _summed(scratch, near.join(far, "near", "left").select("node", F.least("near", "far").alias("label")))
        if now == last:
            return label
        last = now


def _summed(scratch: Scratch, label: DataFrame) -> tuple[DataFrame, object]:
    seen = Observation()
    out = scratch.stage(label.observe(seen, F.sum(F.col("label").cast("decimal(38,0)")).alias("s")), "label")
    return out, seen.get["s"]
