"""T1 over technology files: a stream of CSV files, from the file to the summary.

The stream's source lists the patent folder; a micro-batch is the set of files that
are new (their paths only, no file is read by the stream itself). For the technologies
of these files ``foreachBatch`` runs what the batch job runs: reading, cleaning,
batching, inference with the cache, grading, summary, evidence, coverage, checkpoint.
A run with ``availableNow`` takes what it has not seen and ends; the stream's own
checkpoint names the files that were seen, the job's checkpoint the technologies that
are finished. A micro-batch that dies is replayed: finished technologies are skipped,
answers come from the cache, and the tables are rewritten by technology.

All files of a technology's folder are read when the first of them arrives; a file
that is added to a finished technology is skipped, as the original skips it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Options
from ..operators.inference import InferFn
from ..plans.job import Paths, process_files, read_inputs
from ..sources import inputs
from ..sources import sinks

KEYS = ["domain", "tech_name_raw"]


def arriving_files(spark: SparkSession, patents_dir: str, max_files: int | None = None) -> DataFrame:
    """A stream of (path): the CSV files under ``patents_dir``, each once."""
    reader = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(patents_dir).select("path")


def technology_stream(spark: SparkSession, paths: Paths, infer: InferFn, checkpoint: str,
                      options: Options = Options(), fallback: InferFn | None = None, concurrency: int | None = None,
                      wait_min: float = 1.0, wait_max: float = 20.0, csv: bool = False, max_files: int | None = None):
    """Start T1 over ``paths.patents_dir`` with an availableNow trigger; returns the StreamingQuery.

    Hierarchy and mapping are read when the stream starts; results are those of ``plans.job.run``
    (``sinks.read_summary`` and ``sinks.summary_all`` over ``paths.summary``).
    """
    known = read_inputs(spark, paths)

    def per_batch(arrived: DataFrame, batch_id: int) -> None:
        files = inputs.patent_files(spark, paths.patents_dir, known.techset.domains)
        new = files.join(arrived.select("path"), "path", "left_semi").select(*KEYS).distinct()
        process_files(spark, paths, known, files.join(new, KEYS, "left_semi"), infer, options, fallback, concurrency,
                      wait_min, wait_max, csv)

    return (arriving_files(spark, paths.patents_dir, max_files).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def summary_so_far(spark: SparkSession, paths: Paths) -> DataFrame:
    """K2 over every technology that the stream has finished."""
    return sinks.summary_all(spark, paths.summary, inputs.read_techset(spark, paths.techset).domains_df(spark))
