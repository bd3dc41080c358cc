"""Incremental validation with Structured Streaming.

T1 ``validate_stream``: answered patents arrive as files (Parquet with
(domain, tech_name_raw, patent_id, inferred_codes)). Each micro-batch is graded
against the broadcast expected lists and folded into a stateful aggregation of
four counts per technology (update mode). Every micro-batch hands the updated
totals of the technologies it touched to ``foreachBatch``, which computes
rates, verdict and confidence for them and writes their rows as a new version
of K1. A replayed micro-batch yields the same totals from the versioned state
store, so the sink is idempotent; no micro-batch rereads earlier output, so the cost of a batch
does not grow with the age of the stream. ``trigger(availableNow=True)`` plus
a checkpoint location makes every run process only files it has not seen.

T2 ``running_rates``: the same counts as a stateful streaming aggregation in
update mode; the state is four longs per technology, bounded by the number of
technologies, so no watermark is needed. Updates go to a table of versions.

``evidence_stream`` keeps the first k graded patents of every technology (W4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ..operators import grading
from ..operators.sizing import fits, materialise
from ..sources import sinks
from ..sources.versions import read_latest, write_groups

KEYS = ["domain", "tech_name_raw"]
RATES = ["rate_A", "rate_B", "rate_none", "verdict", "confidence"]
ANSWER_SCHEMA = ("domain string, tech_name_raw string, batch_idx long, patent_id string, "
                 "inferred_codes array<string>")


def read_answers_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ANSWER_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source_dir)


def _fits(resolved: DataFrame) -> bool:
    return fits(resolved, growth=4)  # the pattern arrays, as in the batch job


def validate_stream(spark: SparkSession, source_dir: str, resolved: DataFrame, out_dir: str,
                    checkpoint: str, tau_strong: float = 0.35, tau_min: float = 0.15,
                    max_files: int | None = None, star_prefix: bool = False):
    """Start T1 with an availableNow trigger; returns the StreamingQuery.

    Technologies of ``resolved`` without any row yet get theirs (n_patents 0)
    before the stream starts, as in the batch job.
    """
    summary_path = f"{out_dir}/summary"
    small = _fits(resolved)
    waiting = resolved.join(sinks.read_summary(spark, summary_path).select(*KEYS), KEYS, "left_anti")
    waiting = materialise(waiting)  # it reads the table that is written next
    if not waiting.isEmpty():
        none = spark.createDataFrame([], "domain string, tech_name_raw string, level int")
        sinks.write_summary(grading.validate_tech(none, waiting, tau_strong, tau_min), summary_path)
    answers = read_answers_stream(spark, source_dir, max_files)
    graded = grading.match_patents(answers, resolved, star_prefix=star_prefix, broadcast=small)
    running = grading.tech_counts(graded)

    def per_batch(totals: DataFrame, batch_id: int) -> None:
        # ``totals`` holds only the technologies updated by this micro-batch
        res = grading.validate_from_counts(totals, resolved, tau_strong, tau_min)
        sinks.write_summary(res, summary_path)

    return (running.writeStream.outputMode("update").foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


RUNNING_SCHEMA = StructType([
    StructField("n_patents", LongType()), StructField("hits_a", LongType()), StructField("hits_b", LongType()),
    StructField("hits_none", LongType()), StructField("rate_A", DoubleType()), StructField("rate_B", DoubleType()),
    StructField("rate_none", DoubleType()), StructField("verdict", StringType()), StructField("confidence", DoubleType()),
    StructField("domain", StringType()), StructField("tech_name_raw", StringType())])


def running_rates(spark: SparkSession, source_dir: str, resolved: DataFrame, out_dir: str,
                  checkpoint: str, max_files: int | None = None, tau_strong: float = 0.35, tau_min: float = 0.15):
    """Start T2 (update mode, counts, rates and verdict upserted per technology); returns the StreamingQuery."""
    answers = read_answers_stream(spark, source_dir, max_files)
    graded = grading.match_patents(answers, resolved, broadcast=_fits(resolved))
    running = grading.tech_counts(graded)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rates = grading.validate_from_counts(batch, resolved, tau_strong, tau_min).select(*KEYS, *RATES)
        write_groups(batch.join(rates, KEYS), out_dir, RUNNING_SCHEMA, KEYS)

    return (running.writeStream.outputMode("update").foreachBatch(upsert)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_running(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_latest(spark, out_dir, RUNNING_SCHEMA, KEYS)


FIRST_SCHEMA = StructType([
    StructField("domain", StringType()), StructField("tech_name_raw", StringType()), StructField("epoch", LongType()),
    StructField("batch_idx", LongType()), StructField("patent_id", StringType()), StructField("level", IntegerType()),
    StructField("inferred_codes", ArrayType(StringType()))])
_ORDER = ["batch_idx", "patent_id"]


def evidence_stream(spark: SparkSession, source_dir: str, resolved: DataFrame, out_dir: str, checkpoint: str,
                    k: int = 5, max_files: int | None = None, star_prefix: bool = False):
    """Start W4 over the stream of T1: the first ``k`` graded patents of every technology; returns the StreamingQuery.

    The state is a table of at most k rows for each technology. A micro-batch adds
    its own first k (limited before they are exchanged) to the rows of the
    technologies that it touches and keeps the first k of both. Rows carry the
    number of their micro-batch, and a replayed one takes the place of its earlier try.
    """
    answers = read_answers_stream(spark, source_dir, max_files)
    graded = grading.match_patents(answers, resolved, star_prefix=star_prefix, broadcast=_fits(resolved))

    def first(rows: DataFrame) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*KEYS).orderBy(*_ORDER))
        return rows.withColumn("_nth", nth).where(F.col("_nth") <= k).drop("_nth")

    def merge(batch: DataFrame, batch_id: int) -> None:
        new = materialise(first(batch.withColumn("epoch", F.lit(batch_id).cast("long"))).select(*FIRST_SCHEMA.fieldNames()))
        old = read_latest(spark, out_dir, FIRST_SCHEMA, KEYS).where(F.col("epoch") < batch_id)
        old = old.join(new.select(*KEYS).distinct(), KEYS, "left_semi")
        write_groups(first(new.unionByName(old.select(*new.columns))), out_dir, FIRST_SCHEMA, KEYS)

    return (graded.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_first(spark: SparkSession, out_dir: str, k: int = 5) -> DataFrame:
    """The evidence rows of ``grading.evidence`` from the table of ``evidence_stream``."""
    return grading.evidence(read_latest(spark, out_dir, FIRST_SCHEMA, KEYS), _ORDER, k)
