"""Literal expectations and a property test of the match rule."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxograde.functions import codes as C

# (inferred, expected, level) - the rule's reference table
TABLE = [
    ("G01S17/894", "G01S17/89", "A"),
    ("G01S17/894", "G01S17/*", "A"),
    ("G01S17", "G01S17*", "A"),
    ("G01S17/894", "G01S17*", "none"),
    ("G01S17/89", "G01S17/894", "B"),
    ("G01S17/894", "G01S17", "B"),
    ("G01S17", "G01S17/89", "B"),
    ("G01S17", "G01S", "none"),
]


def _levels(spark, pairs, star_prefix=False, fast=False, lookup_at=C.PREFIX_LOOKUP_AT):
    """Level of each (inferred list, expected list); ``fast`` uses the set-overlap path
    (``lookup_at`` = 1 sends every prefix test through the prefix lookup)."""
    rows = [(i, a if isinstance(a, list) else [a], b) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, ics array<string>, exp array<string>")
    arrays = C.expected_arrays("exp")
    x = df.select("i", "ics", *[v.alias(k) for k, v in arrays.items()])
    if fast:
        out = C.with_best_level(x, "ics", "lvl_n", star_prefix=star_prefix,
                                prefix_lookup_at=lookup_at) \
               .select("i", C.level_name("lvl_n").alias("lvl"))
    else:
        out = x.select("i", C.level_name(C.best_level(C.normalise_codes("ics"),
                                                       star_prefix=star_prefix)).alias("lvl"))
    return {r["i"]: r["lvl"] for r in out.collect()}


def test_match_table(spark):
    for fast in (False, True):
        got = _levels(spark, [(a, [b]) for a, b, _ in TABLE], fast=fast)
        assert [got[i] for i in range(len(TABLE))] == [t[2] for t in TABLE]


def test_star_prefix_opt_in(spark):
    for fast in (False, True):
        got = _levels(spark, [("G01S17/894", ["G01S17*"])], star_prefix=True, fast=fast)
        assert got[0] == "A"


def test_norm_and_group(spark):
    df = spark.createDataFrame([(" g01s 17/89\t",), ("　h04w 4/02 ",), ("",), (None,)], "c string")
    rows = df.select(C.norm_code("c").alias("n"), C.main_group(C.norm_code("c")).alias("g")).collect()
    assert [(r["n"], r["g"]) for r in rows] == [
        ("G01S17/89", "G01S17"), ("H04W4/02", "H04W4"), ("", ""), (None, None)]


def test_tokenise_cell(spark):
    df = spark.createDataFrame([("g01s 17/89， H04w;;B60|x",), (None,)], "c string")
    rows = df.select(C.tokenise_cell("c").alias("t")).collect()
    assert rows[0]["t"] == ["G01S", "17", "89", "H04W", "B60", "X"]
    assert rows[1]["t"] == []


def test_safe_name(spark):
    df = spark.createDataFrame([('a/b:c**d?"e<>|f',)], "s string")
    assert df.select(C.safe_name("s")).first()[0] == "a_b_c_d_e_f"


# ---- property: an independent plain-Python statement of the rule ----------

def _norm(s):
    return s.upper().replace(" ", "").strip() if isinstance(s, str) else ""


def _rule_list(ics, expected):
    levels = [_rule(ic, expected) for ic in ics]
    return "A" if "A" in levels else "B" if "B" in levels else "none"


def _rule(ic, expected):
    i = _norm(ic)
    if not i:
        return "none"
    for e in expected:
        n = _norm(e)
        p = n[:-1] if n.endswith("*") else n
        if i == p or ("/" in p and i.startswith(p)):
            return "A"
    g = i.split("/")[0]
    if g and any(g == _norm(e).split("/")[0] for e in expected):
        return "B"
    return "none"


codes = st.text(alphabet="G1/* \t\u3000", max_size=5)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(codes, st.lists(codes, max_size=3)), min_size=50, max_size=200))
def test_rule_property(spark, pairs):
    got = _levels(spark, pairs)
    for i, (ic, exp) in enumerate(pairs):
        assert got[i] == _rule(ic, exp), (ic, exp)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.lists(codes, max_size=3), st.lists(codes, max_size=3)),
                min_size=50, max_size=200))
def test_list_rule_property(spark, pairs):
    got = _levels(spark, pairs, fast=True)
    for i, (ics, exp) in enumerate(pairs):
        assert got[i] == _rule_list(ics, exp), (ics, exp)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.lists(codes, max_size=3), st.lists(codes, max_size=4)),
                min_size=50, max_size=200))
def test_prefix_lookup_property(spark, pairs):
    """The prefix-lookup form for long pattern lists gives the same levels."""
    got = _levels(spark, pairs, fast=True, lookup_at=1)
    for i, (ics, exp) in enumerate(pairs):
        assert got[i] == _rule_list(ics, exp), (ics, exp)


def test_prefix_lookup_star_and_table(spark):
    pairs = [(i, [e]) for i, e, _ in TABLE]
    assert _levels(spark, pairs, fast=True, lookup_at=1) == {k: lv for k, (_, _, lv) in enumerate(TABLE)}
    star = [("G01S17/894", ["G01S17*"]), ("G01S1", ["G01S17*"]), ("G01S17", ["G01S17*"])]
    assert _levels(spark, star, star_prefix=True, fast=True, lookup_at=1) == \
        _levels(spark, star, star_prefix=True, fast=True, lookup_at=100) == {0: "A", 1: "none", 2: "A"}


def test_bare_star_at_any_list_length(spark):
    """Short and long pattern lists follow the same rule, also for an empty prefix."""
    for n in (1, 14, 15, 16, 17, 40):
        exp = ["*"] + [f"X{k}" for k in range(n - 1)]
        for star in (False, True):
            slow = _levels(spark, [(["G01S17/8"], exp)], star_prefix=star)
            fast = _levels(spark, [(["G01S17/8"], exp)], star_prefix=star, fast=True)
            assert slow == fast == {0: "A" if star else "none"}, (n, star)
