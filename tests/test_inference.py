"""Retries, fallback, cache, and splitting checked against brute force."""

import json
import os

from pyspark.sql import functions as F

from taxograde.operators import batching, inference
from taxograde.plans.fake_infer import FixtureInfer, poison_every


def _requests(spark, sizes, bs):
    rows = []
    k = 0
    for t, n in enumerate(sizes):
        for i in range(n):
            rows.append(("D", f"T{t}", i, str(k), f"title {k}", f"abstract {k}"))
            k += 1
    df = spark.createDataFrame(rows, "domain string, tech_name_raw string, ord long, patent_id string, "
                                     "title string, abstract string")
    return batching.build_batches(batching.assign_batches(df, bs))


def _brute(sizes, bs, poisoned):
    """Plain restatement of the split rule (first parts of max(10, bs//2), bs the
    batch size; then halves max(5, n//2); a failing part of <= 10 is given up)."""
    answered, given_up = set(), set()
    k = 0
    for t, n in enumerate(sizes):
        ids = [str(k + i) for i in range(n)]
        k += n
        for b in range(0, n, bs):
            batch = ids[b:b + bs]
            idx = b // bs + 1

            def go(items, start, first):
                if not any(poisoned(i) for i in items):
                    answered.add((f"T{t}", idx, start, len(items)))
                    return
                if not first and len(items) <= 10:
                    given_up.add((f"T{t}", idx, start, len(items)))
                    return
                size = max(10, bs // 2) if first else max(5, len(items) // 2)
                for s in range(0, len(items), size):
                    go(items[s:s + size], start + s, False)
            go(batch, 0, True)
    return answered, given_up


def test_split_matches_brute_force(spark, tmpdir_fresh):
    sizes, bs = [3, 45, 60, 130, 12, 89], 60  # short last batches, one of 29
    poisoned = poison_every(23, 5)
    req = _requests(spark, sizes, bs)
    answers, failed = inference.infer_with_split(
        req, FixtureInfer(poison=poisoned), tmpdir_fresh + "/work", batching.hierarchy_json([]),
        attempts=2, wait_min=0, wait_max=0)
    got_ok = {(r["tech_name_raw"], r["batch_idx"], r["sub_start"], r["n_items"]) for r in answers.collect()}
    got_bad = {(r["tech_name_raw"], r["batch_idx"], r["sub_start"], r["n_items"]) for r in failed.collect()}
    want_ok, want_bad = _brute(sizes, bs, poisoned)
    assert got_ok == want_ok and got_bad == want_bad
    assert got_bad  # the fixture does give up some parts


def test_retries_and_fallback():
    calls = []

    def flaky(payload):
        calls.append(payload)
        if len(calls) < 3:
            raise ConnectionError("x")
        return "not json"

    wrapped = 'Here: {"patent_batches": []} done'
    text, err, used = inference.call_with_retries("{}", flaky, fallback=lambda p: wrapped,
                                                  wait_min=0, wait_max=0, sleep=lambda s: None)
    assert (text, err, used) == (wrapped, None, 3)
    # a free-text answer without any JSON object fails the attempt: retried, then reported
    calls.clear()
    text, err, used = inference.call_with_retries("{}", lambda p: "not json", fallback=lambda p: "ok text",
                                                  attempts=3, sleep=lambda s: None)
    assert text is None and err.startswith("ValueError") and used == 3
    # without a fallback the answer itself is the free text
    text, err, used = inference.call_with_retries("{}", lambda p: '```json\n{"a": 1}\n```',
                                                  sleep=lambda s: None)
    assert (err, used) == (None, 1)
    text, err, used = inference.call_with_retries("{}", lambda p: 1 / 0, attempts=6,
                                                  sleep=lambda s: None)
    assert text is None and err.startswith("ZeroDivisionError") and used == 6


def test_cache_second_run_makes_no_calls(spark, tmpdir_fresh):
    req = _requests(spark, [5, 7], 4)
    cache = tmpdir_fresh + "/cache"
    inference.infer_with_split(req, FixtureInfer(), tmpdir_fresh + "/w1", "{}",
                               cache_path=cache, wait_min=0, wait_max=0)

    def boom(payload):
        raise AssertionError("called despite cache")

    answers, failed = inference.infer_with_split(req, boom, tmpdir_fresh + "/w2", "{}",
                                                 cache_path=cache, attempts=1, wait_min=0, wait_max=0)
    assert answers.count() == req.count() and failed.count() == 0
    assert answers.where(F.col("attempts") == 0).count() == req.count()


def test_payload_shape(spark):
    req = _requests(spark, [3], 2).orderBy("batch_idx").collect()
    obj = json.loads(req[0]["payload"])
    assert list(obj) == ["patent_batches", "techset_hierarchy"]
    assert obj["patent_batches"][0]["patents"][0] == {"abstract": "abstract 0", "patent_id": "0",
                                                      "title": "title 0"}
    assert [r["n_items"] for r in req] == [2, 1]


def test_every_failing_request_is_reported(spark, tmpdir_fresh):
    """No round limit: whatever never answers ends in ``failed``, item for item."""
    req = _requests(spark, [400], 200)

    def never(payload):
        raise TimeoutError("x")

    answers, failed = inference.infer_with_split(req, never, tmpdir_fresh + "/w", "{}", attempts=1, wait_min=0, wait_max=0)
    assert answers is None or answers.count() == 0
    assert failed.agg(F.sum("n_items")).first()[0] == 400


def test_interrupted_run_repeats_one_wave_at_most(spark, tmpdir_fresh):
    """A worker that dies mid-run leaves the finished waves' answers in the cache."""
    req = _requests(spark, [40], 1)
    calls, cache = tmpdir_fresh + "/calls", tmpdir_fresh + "/cache"
    os.makedirs(calls)

    def infer(payload):
        import uuid
        if len(os.listdir(calls)) >= 33 and not os.path.exists(calls + "/dead"):
            open(calls + "/dead", "w").close()
            os._exit(1)  # the worker, not an exception
        open(f"{calls}/{uuid.uuid4().hex}", "w").close()
        return '{"patent_batches": []}'

    args = dict(cache_path=cache, attempts=1, concurrency=2, wave_requests=8, wait_min=0, wait_max=0)
    try:
        inference.infer_with_split(req, infer, tmpdir_fresh + "/w1", "{}", **args)
    except Exception:  # noqa: BLE001 - the worker's death may fail the job or only a task attempt
        pass
    done = spark.read.parquet(cache).count()
    before = len(os.listdir(calls))
    answers, _ = inference.infer_with_split(req, infer, tmpdir_fresh + "/w2", "{}", **args)
    assert answers.count() == 40 and done >= 16  # waves are dealt by hash: about 8 calls each
    assert len(os.listdir(calls)) - before == 40 - done


def test_number_of_waves_is_bounded(spark, tmpdir_fresh):
    """Each wave writes into every partition of the cache: with more requests the waves grow, not their number."""
    req = _requests(spark, [640], 1)
    answers, failed = inference.infer_with_split(req, lambda payload: '{"patent_batches": []}', tmpdir_fresh + "/w", "{}",
                                                 cache_path=tmpdir_fresh + "/cache", attempts=1, concurrency=1, wait_min=0, wait_max=0)
    assert answers.count() == 640 and failed.count() == 0
    assert len(os.listdir(tmpdir_fresh + "/w/results")) <= inference.MAX_WAVES < 640 // inference.WAVE_CALLS
