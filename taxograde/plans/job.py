"""The whole job: files in, per-technology verdicts out, resumable.

run(spark, paths, infer, options) does, as Spark jobs:

 hierarchy (S1) -> mapping files per domain (S2-S4) -> items (P6-P8)
 patent files (S5, S6) -> technology dimension incl. empty files
 skip finished technologies (J3)
 clean (P1, P4, W1) -> staged Parquet (CSV parsed once, lineage cut)
 batch size (F8 or fixed) -> batches (W2) -> requests (I1, F9)
 cache split (J2) -> inference with retries and splitting (I2-I6) -> raw log (K3)
 parse (N1, N2) -> merge (N3, P9) -> resolve (J1) -> grade (J4, J5, A1)
 -> rates, verdict, confidence (A2-A5) -> K1 summary (+ per-technology CSV)
 -> what was sent against what came back (coverage)
 -> checkpoint (K5), wave by wave of technologies
 consolidated summary over all finished technologies (K2, + summary_all.csv)

Large tables only meet small ones through size-checked broadcasts; the only
exchanges of patent rows are the batch grouping (bounded groups) and the
chunked numbering (bounded window partitions).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Options
from ..operators import batching, coverage, grading, inference, mapping, patents, responses, resume
from ..operators.inference import InferFn
from ..operators.sizing import materialise
from ..session import delete_path, path_exists
from ..sources import inputs, sinks

KEYS = ["domain", "tech_name_raw"]
MERGED = ("domain string, tech_name_raw string, batch_idx long, sub_start long, bpos int, "
          "ppos int, patent_id string, inferred_codes array<string>")


@dataclass
class Paths:
    techset: str
    mappings_dir: str
    patents_dir: str
    outputs_dir: str  # a shared folder on a cluster

    @property
    def summary(self) -> str:
        return f"{self.outputs_dir}/summary"

    @property
    def evidence(self) -> str:
        return f"{self.outputs_dir}/evidence"

    @property
    def coverage(self) -> str:
        return f"{self.outputs_dir}/coverage"

    @property
    def summary_csv(self) -> str:
        return f"{self.outputs_dir}/csv/summary"

    @property
    def summary_all_csv(self) -> str:
        return f"{self.outputs_dir}/csv/summary_all.csv"

    @property
    def checkpoints(self) -> str:
        return f"{self.outputs_dir}/state/checkpoints"

    @property
    def cache(self) -> str:
        return f"{self.outputs_dir}/raw/cache"

    @property
    def raw(self) -> str:
        return f"{self.outputs_dir}/raw/responses"

    @property
    def failed(self) -> str:
        return f"{self.outputs_dir}/raw/failed"

    def work(self, run_id: str) -> str:
        return f"{self.outputs_dir}/work/{run_id}"


@dataclass
class RunResult:
    summary_all: DataFrame
    processed: DataFrame
    failed: DataFrame
    missing_domains: list[str]


@dataclass
class Inputs:
    """What every file of a run is held against: hierarchy and expert mapping."""
    techset: inputs.Techset
    domains: DataFrame
    items: DataFrame


def read_inputs(spark: SparkSession, paths: Paths) -> Inputs:
    ts = inputs.read_techset(spark, paths.techset)
    domains = ts.domains_df(spark)
    items = materialise(inputs.read_mapping_items(spark, inputs.detect_mapping(spark, paths.mappings_dir, domains)))
    return Inputs(ts, domains, items)


def run(spark: SparkSession, paths: Paths, infer: InferFn, options: Options = Options(),
        fallback: InferFn | None = None, concurrency: int | None = None,
        wait_min: float = 1.0, wait_max: float = 20.0, csv: bool = True) -> RunResult:
    """Process every technology that is not finished yet, in waves.

    A wave's technologies are inferred, graded, written and marked as done
    before the next wave starts, so a run that dies repeats unfinished waves
    only (and of their calls only those whose answers the cache has not got).
    """
    known = read_inputs(spark, paths)
    files = inputs.patent_files(spark, paths.patents_dir, known.techset.domains)
    todo, failed, missing = process_files(spark, paths, known, files, infer, options, fallback, concurrency,
                                          wait_min, wait_max, csv)
    everything = sinks.summary_all(spark, paths.summary, known.domains)
    if csv:
        sinks.export_csv(everything, paths.summary_all_csv)
    return RunResult(everything, todo, failed, missing)


def process_files(spark: SparkSession, paths: Paths, known: Inputs, files: DataFrame, infer: InferFn,
                  options: Options = Options(), fallback: InferFn | None = None, concurrency: int | None = None,
                  wait_min: float = 1.0, wait_max: float = 20.0, csv: bool = True) -> tuple[DataFrame, DataFrame, list[str]]:
    """The technologies of ``files`` (of ``patent_files``) that are not finished yet, from file to summary.

    Returns (technologies processed, abandoned batches, domains without a file).
    """
    work = paths.work(uuid.uuid4().hex)
    ts = known.techset
    tech = files.select(*KEYS).distinct()
    todo = materialise(resume.skip_done(tech, resume.read_checkpoints(spark, paths.checkpoints)))
    pf = inputs.read_patents(spark, paths.patents_dir, ts.domains, options.id_col, options.title_col,
                             options.abstract_col, files=files.join(todo, KEYS, "left_semi"))
    waves = -(-todo.count() // options.wave_technologies)
    wave_of = F.pmod(F.xxhash64(*KEYS), F.lit(max(1, waves)))
    old_raw = materialise(inference.raw_keys(spark, paths.raw, todo))

    if pf.rows is not None and waves:
        cleaned = patents.clean_patents(pf.rows, "title", "abstract", "patent_id")
        (patents.truncate_text(cleaned).withColumn("wave", wave_of)
         .write.mode("overwrite").partitionBy("wave").parquet(f"{work}/patents"))
    failed_path = f"{work}/failed"
    for wave in range(waves):
        tech = todo.where(wave_of == wave)
        merged, staged = spark.createDataFrame([], MERGED), None
        if pf.rows is not None and path_exists(spark, f"{work}/patents/wave={wave}"):
            staged = spark.read.parquet(f"{work}/patents/wave={wave}")
            size = (batching.auto_batch_size(None, staged, options.context_limit, options.auto_batch_cap)
                    if options.auto_batch else options.batch_size)
            requests = batching.build_batches(batching.assign_batches(staged, size), ts.text, options.model_id)
            answers, failed = inference.infer_with_split(
                requests, infer, f"{work}/waves/{wave}", ts.text, fallback=fallback, cache_path=paths.cache,
                model_id=options.model_id, concurrency=concurrency, wait_min=wait_min, wait_max=wait_max)
            if not failed.isEmpty():
                failed.write.mode("append").parquet(paths.failed)
                failed.write.mode("append").parquet(failed_path)
            if answers is not None:
                inference.append_raw(answers, paths.raw, old_raw)
                merged = responses.merge_responses(responses.parse_responses(answers, "response"), "batch_idx")
        resolved = mapping.resolve_expected(tech, known.items)  # written once, measured
        # graded once, for the summary, the evidence and the coverage
        matched = materialise(grading.match_patents(merged, resolved, star_prefix=options.star_prefix))
        results = materialise(grading.validate_tech(matched, resolved, options.tau_strong, options.tau_min))
        sinks.write_summary(results, paths.summary)
        if csv:  # the original's per-technology files, of this wave's technologies
            sinks.export_summary_csv(results, paths.summary_csv)
        ev = grading.evidence(matched, ["batch_idx", "sub_start", "bpos", "ppos"], options.max_evidence)
        sinks.write_evidence(ev, paths.evidence)
        sent = matched.limit(0).select(*KEYS, "patent_id") if staged is None else staged.select(*KEYS, "patent_id")
        sinks.write_coverage(coverage.coverage_report(sent, matched, tech), paths.coverage)
        resume.mark_done(tech, paths.checkpoints)
        delete_path(spark, f"{work}/waves/{wave}")
    delete_path(spark, f"{work}/patents")
    failed = (spark.read.parquet(failed_path) if path_exists(spark, failed_path)
              else spark.createDataFrame([], "domain string, tech_name_raw string"))
    return todo, failed, _missing_domains(files, ts.domains)


def _missing_domains(files: DataFrame, domains: list[str]) -> list[str]:
    found = {r[0] for r in files.select("domain").distinct().collect()}  # at most the hierarchy's domains
    return [d for d in domains if d not in found]
