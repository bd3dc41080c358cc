"""Grading by equi-joins of codes and patterns equals grading by lists; coverage of sent and returned ids."""

import random

from taxograde.operators import coverage, grading

RES = "domain string, tech_name_raw string, item_ord long, resolution_tier int, expected_codes array<string>"
INF = "domain string, tech_name_raw string, patent_id string, inferred_codes array<string>, note array<string>"


def test_by_code_equals_by_list(spark):
    rng = random.Random(4)

    def code():
        c = rng.choice("GH") + rng.choice(["01", "0"]) + rng.choice(["S", ""]) + rng.choice(["", "/", "/8", "/89", " 17/8"])
        return rng.choice([c, c.lower(), c + "*", " " + c])
    res = [("D", f"T{t}", 0, 0, [code() for _ in range(rng.choice([0, 1, 3, 40]))] + rng.choice([[], ["*"], [""], ["/"]]))
           for t in range(20)]
    inf = [("D", f"T{rng.randrange(23)}", str(i), rng.choice([None, [], [None], [code() for _ in range(3)], ["", code()], [code()]]), ["n"])
           for i in range(800)]
    inf += inf[:50]  # repeated rows stay apart
    r, f = spark.createDataFrame(res, RES), spark.createDataFrame(inf, INF)
    for star in (False, True):
        a, b = (sorted(map(str, df.collect())) for df in (grading.match_patents(f, r, star, broadcast=True),
                                                          grading.match_by_code(f, r, star)))
        assert a == b and any("level=2" in x for x in a) and any("level=1" in x for x in a)
    assert grading.match_by_code(f, r).dtypes == grading.match_patents(f, r, broadcast=True).dtypes


def test_coverage(spark):
    keys = "domain string, tech_name_raw string, patent_id string"
    sent = [("D", "a", x) for x in ["1", "2", "2", "3", None]] + [("D", "b", "1")]
    back = [("D", "a", x) for x in ["1", "1", "2", "2", "2", "9", "9", None]] + [("D", "c", "7")]
    got = coverage.coverage_report(spark.createDataFrame(sent, keys), spark.createDataFrame(back, keys),
                                   spark.createDataFrame([("D", t) for t in "abcd"], "domain string, tech_name_raw string"))
    assert {tuple(r)[1:] for r in got.collect()} == {("a", 5, 8, 1, 2, 2), ("b", 1, 0, 1, 0, 0), ("c", 0, 1, 0, 1, 0), ("d", 0, 0, 0, 0, 0)}
    assert coverage.coverage_report(spark.createDataFrame([], keys), spark.createDataFrame([], keys)).count() == 0
