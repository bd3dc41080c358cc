"""Batch inference with a content-keyed cache and splitting of failed batches.

I2-I4  ``batch_infer``      call a user function on every cache miss inside
                            ``mapInPandas``; bounded retries; a batch that still
                            fails is reported in ``error`` instead of failing
                            the task
I5     ``infer_with_split`` failed batches are regrouped into smaller ones,
                            round by round, until they answer or are at most
                            10 items; those go to the ``failed`` table
I6/J2  ``split_cached``     cache hits / misses by ``cache_key`` (semi / anti join)
K4     ``append_cache``     append new valid answers, deduplicated by key, in
                            partitions by the keys' first characters
S8     ``read_cache``       the partitions that the requests touch, what cannot
                            be read left out
K3     ``append_raw``       append raw answers not stored yet

External calls and task retries: every round's answers are written once to
Parquet and everything downstream reads that table, so recomputing a lost
partition later never calls the function again. Speculation is off for the
session (see ``session.DEFAULT_CONF``). Concurrency is bounded by the number
of partitions given to ``mapInPandas``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import (RETRY_ATTEMPTS, RETRY_WAIT_MAX, RETRY_WAIT_MIN,
                      SPLIT_GIVE_UP_AT, SPLIT_MIN_FIRST, SPLIT_MIN_HALF)
from ..functions.json_text import first_json_text
from ..session import path_exists
from ..sources.tolerant import read_tolerant

KEYS = ["domain", "tech_name_raw"]
BATCH_ID = [*KEYS, "batch_idx", "sub_start"]

InferFn = Callable[[str], str]

#: Calls of one concurrent task in a wave: what an interrupted run may have to repeat.
WAVE_CALLS = 16
#: Waves of one round at most. A wave costs a few jobs and a file in every partition of the
#: cache whatever its size, so with waves of a fixed size these grow with the requests.
MAX_WAVES = 8

RESULT_SCHEMA = ("domain string, tech_name_raw string, batch_idx long, sub_start long, "
                 "n_items long, cache_key string, response string, error string, attempts int")


def _valid_object(text: str | None) -> bool:
    try:
        obj = json.loads(text or "")
    except ValueError:
        return False
    return isinstance(obj, dict) and "patent_batches" in obj


def _answer(payload: str, text: str, fallback: InferFn | None) -> str:
    """One attempt's answer, as the original accepted it.

    An object with ``patent_batches`` is taken as it is. Otherwise the free-text
    answer (the ``fallback``'s, or this text when there is no fallback) must
    hold a JSON object somewhere; if it holds none, the attempt fails and is
    retried. An object without ``patent_batches`` is an empty result later.
    """
    if _valid_object(text):
        return text
    free = fallback(payload) if fallback is not None else text
    if first_json_text(free) is None:
        raise ValueError("no JSON object in the answer")
    return free


def call_with_retries(payload: str, infer: InferFn, fallback: InferFn | None = None,
                      attempts: int = RETRY_ATTEMPTS, wait_min: float = RETRY_WAIT_MIN,
                      wait_max: float = RETRY_WAIT_MAX,
                      sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int]:
    """(response text, error, attempts used).

    One attempt asks ``infer``; when its answer is not an object with
    ``patent_batches``, the ``fallback`` is asked for free text (see
    ``_answer``). Any exception, including an answer without a JSON object,
    retries the attempt after an exponential wait bounded to
    [wait_min, wait_max]; after the last attempt the error is reported.
    """
    last = None
    for k in range(1, attempts + 1):
        try:
            return _answer(payload, infer(payload), fallback), None, k
        except Exception as e:  # noqa: BLE001 - any failure is retried, then reported
            last = f"{type(e).__name__}: {e}"
            if k < attempts:
                sleep(min(wait_max, max(wait_min, 2.0 ** k)))
    return None, last, attempts


def batch_infer(requests: DataFrame, infer: InferFn, fallback: InferFn | None = None,
                attempts: int = RETRY_ATTEMPTS, concurrency: int | None = None,
                wait_min: float = RETRY_WAIT_MIN, wait_max: float = RETRY_WAIT_MAX) -> DataFrame:
    """Run the function for every request row; one result row per request.

    ``concurrency`` is the number of tasks that call the function at the same
    time: requests are spread over that many partitions by their key. The
    default is the session's parallelism, since the step waits on the service,
    not on the CPU (a small job would otherwise sit in the one or two
    partitions that AQE coalesces it into); 0 keeps the incoming partitioning.
    """
    if "sub_start" not in requests.columns:
        requests = requests.withColumn("sub_start", F.lit(0).cast("long"))
    cols = [*BATCH_ID, "n_items", "cache_key", "payload"]
    reqs = requests.select(*cols)
    if concurrency is None:
        concurrency = requests.sparkSession.sparkContext.defaultParallelism
    if concurrency:
        reqs = reqs.repartition(concurrency, "cache_key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                text, err, used = call_with_retries(r.payload, infer, fallback, attempts,
                                                    wait_min, wait_max)
                out.append((r.domain, r.tech_name_raw, r.batch_idx, r.sub_start, r.n_items,
                            r.cache_key, text, err, used))
            yield pd.DataFrame(out, columns=["domain", "tech_name_raw", "batch_idx", "sub_start",
                                             "n_items", "cache_key", "response", "error", "attempts"])

    return reqs.mapInPandas(run, RESULT_SCHEMA)


CACHE_SCHEMA = "cache_key string, response string, key_prefix string"
#: Characters of a key that name its partition of the cache: 256 partitions.
PREFIX_CHARS = 2


def key_prefix(key: str = "cache_key") -> Column:
    return F.substring(key, 1, PREFIX_CHARS)


def read_cache(spark: SparkSession, path: str | None, requests: DataFrame | None = None) -> DataFrame:
    """(cache_key, response) of the readable answers that are JSON.

    With ``requests`` only the partitions that their keys fall into are read. A
    file that cannot be read, or an answer that is not JSON, is no answer: its
    request is asked again.
    """
    cache = read_tolerant(spark, path, CACHE_SCHEMA)
    if requests is not None:
        touched = [r[0] for r in requests.select(key_prefix().alias("p")).distinct().collect()]  # at most 256
        cache = cache.where(F.col("key_prefix").isin(touched))
    return cache.where(F.try_parse_json("response").isNotNull()).select("cache_key", "response")


def split_cached(requests: DataFrame, cache: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(hits with ``response``, misses). The cache holds (cache_key, response)."""
    if cache is None:
        cache = requests.sparkSession.createDataFrame([], "cache_key string, response string")
    # the writer appends only keys that are not there yet: a key has one answer
    hits = requests.join(cache.select("cache_key", "response"), "cache_key", "inner")
    misses = requests.join(cache.select("cache_key"), "cache_key", "left_anti")
    return hits, misses


def _read_or_none(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The table at ``path``; None where there is none yet. Other failures are raised."""
    if not path or not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a folder that no write has finished in
            raise
        return None


def append_cache(results: DataFrame, cache_path: str, known_missing: bool = False) -> None:
    """K4: keep answers that parse to an object with patent_batches; append new keys.

    The cache is partitioned by the keys' first characters, and only the
    partitions of the new keys are read. ``known_missing``: the keys are those of
    requests that the cache did not have, so it is not read at all.
    """
    ok = results.where(F.col("error").isNull() & F.col("response").isNotNull())
    parsed = F.try_parse_json(F.col("response"))
    fresh = (ok.where(F.try_variant_get(parsed, "$.patent_batches", "variant").isNotNull())
               .select("cache_key", "response").dropDuplicates(["cache_key"]))
    if not known_missing:
        fresh = fresh.join(read_cache(results.sparkSession, cache_path, ok).select("cache_key"), "cache_key", "left_anti")
    (fresh.withColumn("key_prefix", key_prefix()).repartition("key_prefix")
          .write.mode("append").partitionBy("key_prefix").parquet(cache_path))


RAW_KEY = [*BATCH_ID, "cache_key"]


def raw_keys(spark: SparkSession, raw_path: str, tech: DataFrame) -> DataFrame:
    """The keys of the raw answers of some technologies."""
    old = _read_or_none(spark, raw_path)
    if old is None:
        return spark.createDataFrame([], "domain string, tech_name_raw string, batch_idx long, sub_start long, cache_key string")
    return old.select(*RAW_KEY).join(tech.select(*KEYS), KEYS, "left_semi")


def append_raw(results: DataFrame, raw_path: str, old: DataFrame | None = None) -> None:
    """K3: one row per (technology, batch, key); never overwritten.

    ``old``: the keys already there for these technologies, where the caller has them.
    """
    new = results.dropDuplicates(RAW_KEY)
    if old is None:
        old = raw_keys(results.sparkSession, raw_path, results.select(*KEYS).distinct())
    new.join(old, RAW_KEY, "left_anti").write.mode("append").parquet(raw_path)


def _split(failed_requests: DataFrame, first_round: bool, hierarchy: str,
           model_id: str) -> DataFrame:
    """Regroup the patents of failed (sub-)batches into smaller requests."""
    from .batching import request_columns  # local import: avoids a cycle
    # the first cut is half the technology's batch size, later ones half the part
    n = F.coalesce("batch_size", "n_items") if first_round and "batch_size" in failed_requests.columns else F.col("n_items")
    size = F.greatest(F.lit(SPLIT_MIN_FIRST if first_round else SPLIT_MIN_HALF), F.floor(n / 2)).cast("long")
    items = failed_requests.select(*BATCH_ID, size.alias("_size"),
                                   F.posexplode("patents").alias("_i", "_p"))
    items = items.withColumn("_part", F.floor(F.col("_i") / F.col("_size")).cast("long"))
    grouped = items.groupBy(*KEYS, "batch_idx", "sub_start", "_part", "_size").agg(
        F.array_sort(F.collect_list(F.struct("_i", "_p"))).alias("_items"))
    return request_columns(
        grouped.select(*KEYS, "batch_idx",
                       (F.col("sub_start") + F.col("_part") * F.col("_size")).alias("sub_start"),
                       F.transform("_items", lambda x: x["_p"]).alias("patents")),
        hierarchy, model_id)


def infer_with_split(requests: DataFrame, infer: InferFn, work_dir: str,
                     hierarchy: str, fallback: InferFn | None = None,
                     cache_path: str | None = None, model_id: str = "",
                     attempts: int = RETRY_ATTEMPTS, concurrency: int | None = None,
                     wait_min: float = RETRY_WAIT_MIN, wait_max: float = RETRY_WAIT_MAX,
                     wave_requests: int | None = None) -> tuple[DataFrame, DataFrame]:
    """I2-I6 with splitting. Returns (answers, failed).

    answers: (domain, tech_name_raw, batch_idx, sub_start, n_items, cache_key,
    response, error, attempts) for every request that answered, from the cache
    or from the function. failed: the abandoned sub-batches with their patents.

    Splitting rule (the original's loop, without its two defects): a failed
    batch is cut into parts of max(10, batch size // 2), the batch size being
    the technology's (``batch_size``; without it the batch's own size); a failed
    part of more than 10 items into halves of max(5, n // 2); a failed part of
    at most 10 items is given up. An abandoned part contributes no rows. Parts
    shrink in every round, so the loop ends by itself.

    The requests of a round are asked in waves of about ``wave_requests`` (by
    default ``WAVE_CALLS`` calls for each concurrent task, more where that makes
    over ``MAX_WAVES`` waves); the cache takes a wave's answers as soon as they are
    written, so a run that dies repeats the calls of one wave at most. Every request is written once and read by its own
    wave, so the bytes read grow with the number of requests.
    """
    from .batching import payload_column  # local import: avoids a cycle
    spark = requests.sparkSession
    if "sub_start" not in requests.columns:
        requests = requests.withColumn("sub_start", F.lit(0).cast("long"))
    lanes = concurrency or spark.sparkContext.defaultParallelism
    pending = requests
    answers_path = f"{work_dir}/answers"
    failed_path = f"{work_dir}/failed"
    small = F.lit(False)
    rnd = 0
    while True:
        # one write per round: hits, misses and failures all read this table,
        # so the batch building above it runs once and stays consistent; the
        # payload is made again from it where the function is called
        req_path = f"{work_dir}/requests={rnd}"
        seen = Observation()
        (pending.drop("payload").observe(seen, F.count(F.lit(1)).alias("n"))
                .write.mode("overwrite").parquet(req_path))
        n = seen.get["n"]
        waves = max(1, -(-n // wave_requests) if wave_requests else min(MAX_WAVES, -(-n // (WAVE_CALLS * lanes))))
        pending = spark.read.parquet(req_path)
        hits, misses = split_cached(pending, read_cache(spark, cache_path, pending) if cache_path else None)
        hits.select(*BATCH_ID, "n_items", "cache_key", "response",
                    F.lit(None).cast("string").alias("error"),
                    F.lit(0).alias("attempts")).write.mode("append").parquet(answers_path)
        # written once, a folder for each wave: a wave reads its own requests only. Requests
        # of one key are of one wave, so no wave asks what an earlier one has put into the cache
        miss_path = f"{work_dir}/misses={rnd}"
        columns = misses.schema
        (misses.withColumn("wave", F.pmod(F.xxhash64("cache_key"), F.lit(waves)))
               .repartition("wave", F.pmod(F.xxhash64("cache_key", "batch_idx"), F.lit(lanes)))
               .write.mode("overwrite").partitionBy("wave").parquet(miss_path))
        parts = []
        for wave in range(waves):
            if not path_exists(spark, f"{miss_path}/wave={wave}"):
                continue
            asked = spark.read.schema(columns).parquet(f"{miss_path}/wave={wave}")
            part = f"{work_dir}/results/round={rnd}-{wave}"
            batch_infer(asked.withColumn("payload", payload_column(hierarchy)), infer, fallback, attempts, concurrency,
                        wait_min, wait_max).write.mode("overwrite").parquet(part)
            parts.append(part)
            res = spark.read.parquet(part)
            if cache_path:
                append_cache(res, cache_path, known_missing=True)
            res.where(F.col("error").isNull()).write.mode("append").parquet(answers_path)
        if not parts:
            break
        errors = spark.read.parquet(*parts).where(F.col("error").isNotNull()).select(*BATCH_ID)
        bad = spark.read.schema(columns).parquet(miss_path).join(errors, BATCH_ID, "left_semi")
        retry_path = f"{work_dir}/retry={rnd}"
        bad.withColumn("_over", small).write.mode("overwrite").parquet(retry_path)
        bad = spark.read.parquet(retry_path)
        bad.where("_over").select(*BATCH_ID, "n_items", "patents").write.mode("append").parquet(failed_path)
        retry = bad.where("not _over").drop("_over")
        if retry.isEmpty():
            break
        pending = _split(retry, rnd == 0, hierarchy, model_id)
        small = F.col("n_items") <= SPLIT_GIVE_UP_AT  # from the second round on
        rnd += 1
    answers = _read_or_none(spark, answers_path)
    failed = _read_or_none(spark, failed_path)
    if failed is None:
        failed = spark.createDataFrame(
            [], "domain string, tech_name_raw string, batch_idx long, sub_start long, n_items long, "
                "patents array<struct<abstract:string,patent_id:string,title:string>>")
    return answers, failed
