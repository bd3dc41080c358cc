"""Plan shapes that the design relies on at scale, checked on the physical plan.

AQE is switched off inside these tests so the plan holds the planned exchanges
(with AQE on they are wrapped in query stages decided at run time).
"""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from taxograde.operators import grading
from taxograde.operators.numbering import positions
from taxograde.operators.sizing import bounded_broadcast
from taxograde.plans import catalog

from conftest import SF_SMALL

ROW_COLUMNS = {"patent_id", "inferred_codes", "ord", "title", "abstract"}


@contextmanager
def no_aqe(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def nodes(df):
    """Every node of the executed physical plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        n = todo.pop()
        out.append(n)
        ch = n.children()
        todo.extend(ch.apply(i) for i in range(ch.size()))
    return out


def names(attrs):
    return {attrs.apply(i).name() for i in range(attrs.size())}


def exchanges(df):
    return [n for n in nodes(df) if n.nodeName() == "Exchange"]


@pytest.fixture(scope="module")
def res(spark):
    return catalog.resolved(spark, SF_SMALL)


def test_grading_shuffles_only_counts(spark, res):
    """Patent rows are graded where they lie; only per-technology partial
    counts cross the exchange, so a technology with a third of all rows costs
    nothing extra."""
    with no_aqe(spark):
        df = grading.validate_tech(catalog.matched(spark, SF_SMALL, res), res)
        plan = nodes(df)
        assert any(n.nodeName() == "BroadcastHashJoin" for n in plan)
        for ex in exchanges(df):
            assert not (names(ex.output()) & ROW_COLUMNS), ex.toString()


def test_scan_reads_only_needed_columns(spark, res):
    with no_aqe(spark):
        df = catalog.q_match_patent(spark, SF_SMALL)
        scans = [n for n in nodes(df) if n.nodeName().startswith("Scan parquet")
                 and "documents" in n.toString()]
        assert scans
        for s in scans:
            assert "text" not in set(s.requiredSchema().fieldNames())


def test_evidence_limits_before_the_exchange(spark, res):
    """row_number() <= k is planned with a partial group limit below the
    exchange: at most k rows per technology and task are shuffled."""
    with no_aqe(spark):
        df = grading.evidence(catalog.matched(spark, SF_SMALL, res), ["ord"], k=5)
        seen_partial = False
        for ex in exchanges(df):
            below = []
            todo = [ex.child()]
            while todo:
                n = todo.pop()
                below.append(n)
                ch = n.children()
                todo.extend(ch.apply(i) for i in range(ch.size()))
            seen_partial |= any(n.nodeName() == "WindowGroupLimit" for n in below)
        assert seen_partial


def test_numbering_never_windows_a_whole_group(spark):
    """Row-level windows partition by (technology, chunk), never by the
    technology alone."""
    with no_aqe(spark):
        df = positions(catalog.clean_view(spark, SF_SMALL), ["domain", "tech_name_raw"], "ord")
        windows = [n for n in nodes(df) if n.nodeName() == "Window"]
        assert windows
        for w in windows:
            if names(w.output()) & ROW_COLUMNS:
                spec = w.partitionSpec().toString()
                assert "_chunk" in spec, spec


def test_broadcast_only_under_the_bound(spark, res):
    small = bounded_broadcast(res)
    big = bounded_broadcast(res, max_rows=0)
    inf = catalog.inferred_lists(spark, SF_SMALL)
    with no_aqe(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined_small = inf.join(small, ["domain", "tech_name_raw"])
            joined_big = inf.join(big, ["domain", "tech_name_raw"])
            assert any(n.nodeName() == "BroadcastExchange" for n in nodes(joined_small))
            assert not any(n.nodeName() == "BroadcastExchange" for n in nodes(joined_big))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_are_bounded_groups(spark):
    """collect_list runs per (technology, batch): no group exceeds the batch size."""
    b = catalog.batches(spark, SF_SMALL).drop("batch_size")
    sizes = catalog.auto_sizes(spark, SF_SMALL)
    over = (b.join(sizes, ["domain", "tech_name_raw"])
             .where(F.col("n_items") > F.col("batch_size")).count())
    assert over == 0


def test_batching_never_deals_text_by_technology_alone(spark):
    """With a size table and no broadcast: patent text is exchanged on
    (technology, chunk) and (technology, batch) only."""
    from taxograde.operators import batching
    from taxograde.operators.sizing import materialise
    sizes = materialise(catalog.auto_sizes(spark, SF_SMALL))  # its sample is limited before its exchange
    with no_aqe(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = batching.build_batches(batching.assign_batches(catalog.clean_view(spark, SF_SMALL), sizes))
            text = [ex for ex in exchanges(df) if names(ex.output()) & {"title", "abstract", "_items", "buf"}
                    or "collect_list" in ex.toString()]
            assert text
            for ex in text:
                how = ex.outputPartitioning().toString()
                assert "_chunk" in how or "batch_idx" in how, how
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_expected_lists_are_matched_by_code(spark, res):
    """Where the expected lists are refused a broadcast, no list is held on a row or
    repeated, no exchange deals answers by the technology alone, and the levels are the same."""
    inf = catalog.inferred_lists(spark, SF_SMALL)
    small = grading.match_patents(inf, res, broadcast=True)
    with no_aqe(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            large = grading.match_patents(inf, res, broadcast=False)
            answers = [ex for ex in exchanges(large) if names(ex.output()) & {"inferred_codes", "_row"}]
            assert answers
            for ex in answers:
                how = ex.outputPartitioning().toString()
                assert "_row" in how or "code" in how, how
            for n in nodes(large):
                assert not names(n.output()) & {"exp_pats", "exp_groups", "_salt"}
                assert not (names(n.output()) >= {"_row", "expected_codes"})
            cols = ["domain", "tech_name_raw", "patent_id", "level"]
            assert sorted(large.select(cols).collect()) == sorted(small.select(cols).collect())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


PYTHON_NODES = ("Python", "Pandas", "Arrow")


def test_parsing_stays_in_the_jvm(spark):
    df = catalog.q_parse_responses(spark, SF_SMALL)
    assert not [n.nodeName() for n in nodes(df) if any(p in n.nodeName() for p in PYTHON_NODES)]


def test_cache_lookup_prunes_partitions(spark):
    """A lookup and an append read the partitions of their keys only."""
    from taxograde.operators import inference
    from taxograde.session import shared_path
    path = shared_path(spark, "t", "cache")
    keys = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("cache_key"),
                                    F.lit('{"patent_batches":[]}').alias("response"), F.lit(None).cast("string").alias("error"))
    inference.append_cache(keys, path)
    one = keys.limit(1)
    with no_aqe(spark):
        df = inference.read_cache(spark, path, one)
        scan = [n for n in nodes(df) if n.nodeName().startswith("Scan parquet")][0]
        assert "key_prefix" in scan.toString().split("PartitionFilters")[1].split("]")[0]
        assert 0 < df.count() < 40
        scan.execute()
        read = [n for n in nodes(df) if n.nodeName().startswith("Scan parquet")][0]
        assert read.selectedPartitions().partitionCount() == 1
    hits, misses = inference.split_cached(one.drop("response"), df)
    assert hits.count() == 1 and misses.count() == 0


def test_csv_files_of_one_header_are_one_scan(spark, tmp_path):
    """Each header group is one scan (beside the pass that counts where its splits begin), without Python."""
    from taxograde.sources import inputs
    root = tmp_path / "patents" / "A"
    root.mkdir(parents=True)
    for i in range(9):
        head = "title,abstract" if i % 3 else "abstract,patent id,title"
        (root / f"t{i}.csv").write_text(f"{head}\n" + "".join(f"x{i}{j},y,z\n"[:None if not i % 3 else -3] + ("" if not i % 3 else "\n")
                                                              for j in range(5)))
    with no_aqe(spark):
        rows = inputs.read_patents(spark, str(tmp_path / "patents"), ["A"]).rows
        scans = [n for n in nodes(rows) if n.nodeName().startswith("Scan csv")]
        assert len(scans) == 2
        for s in scans:
            assert len(s.requiredSchema().fieldNames()) <= 3
        assert not [n for n in nodes(rows) if any(p in n.nodeName() for p in PYTHON_NODES)]
        assert rows.count() == 45


PAIR_OPERATORS = {"CartesianProduct", "BroadcastNestedLoopJoin"}


def test_no_all_pairs_operators(spark, monkeypatch):
    """Resolution, grading and batching never plan a cartesian product or a
    nested-loop join (which would compare all pairs)."""
    from taxograde.operators import mapping, sizing
    staged = []
    real = sizing.materialise

    def capture(df):
        staged.append(df)
        return real(df)
    monkeypatch.setattr(mapping, "materialise", capture)
    res = catalog.resolved(spark, SF_SMALL)
    with no_aqe(spark):
        plans = staged + [grading.validate_tech(catalog.matched(spark, SF_SMALL, res), res),
                          catalog.q_batch_payload(spark, SF_SMALL),
                          catalog.q_evidence_topk(spark, SF_SMALL)]
        for df in plans:
            used = {n.nodeName() for n in nodes(df)}
            assert not (used & PAIR_OPERATORS), used & PAIR_OPERATORS
