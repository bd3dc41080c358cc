"""Response texts to parsed objects and statuses."""

import pytest

from taxograde.functions.json_text import first_json_text
from taxograde.operators.responses import merge_responses, parse_responses

OBJ = '{"patent_batches":[{"domain":"D","tech_name_raw":"T","patents":[{"patent_id":1,"inferred_codes":["G01S"]}]}]}'

CASES = [
    # (text, parse_status, number of merged patents)
    (OBJ, "ok", 1),
    ("```json\n" + OBJ + "\n```", "ok", 1),               # fenced
    ("  " + OBJ + "\n", "ok", 1),                          # surrounding whitespace
    ("Here it is: " + OBJ + " Done.", "ok", 1),           # prose around the object
    # the first object that parses wins; a brace inside a string does not end
    # it (deliberate deviation: the original's scan ignores quoting and finds none)
    ('Note {"x": "a } b"} then ' + OBJ, "no_batches", 0),
    ("Sure! {not json} and then " + OBJ, "ok", 1),        # first balanced object that parses
    ('{"a": 1}', "no_batches", 0),                         # an object without patent_batches
    ("[1, 2]", "no_batches", 0),                           # valid JSON, not an object
    ("oops", "error", 0),                                  # no JSON at all
    ("", "error", 0),
    ("{{{", "error", 0),                                   # unbalanced
]


@pytest.mark.parametrize("text,status,n", CASES)
def test_first_json_text(text, status, n):
    got = first_json_text(text)
    assert (got is None) == (status == "error")


def test_parse_and_merge(spark):
    rows = [("D", "T", i, t) for i, (t, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "domain string, tech_name_raw string, ord long, raw_text string")
    parsed = parse_responses(df, "raw_text")
    got = {r["ord"]: r["parse_status"] for r in parsed.select("ord", "parse_status").collect()}
    assert got == {i: s for i, (_, s, _) in enumerate(CASES)}
    merged = merge_responses(parsed, order_col="ord")
    counts = {}
    for r in merged.select("batch_idx").collect():
        counts[r["batch_idx"]] = counts.get(r["batch_idx"], 0) + 1
    assert {i: counts.get(i, 0) for i in range(len(CASES))} == {i: n for i, (_, _, n) in enumerate(CASES)}


def test_wrapped_answers_need_no_python(spark):
    """Fenced and prose-wrapped objects are read by the built-in parser."""
    from pyspark.sql import functions as F
    from taxograde.functions.json_text import balanced_objects, first_json_text
    from taxograde.operators.responses import parse_responses
    texts = ['{"patent_batches": []}', '```json\n{"patent_batches": []}\n```', 'Here: {"patent_batches": [{"x": "}"}]} done',
             '[{"patent_batches": []}]', "null", "none", 'a {b} {"patent_batches": []}', "true", "", "{", 'x {"a": 1} y {"patent_batches": []}']
    df = spark.createDataFrame([(t,) for t in texts], "raw_text string")
    got = [r["parse_status"] for r in parse_responses(df).select("raw_text", "parse_status").collect()]
    assert got == ["ok", "ok", "ok", "no_batches", "no_batches", "error", "ok", "no_batches", "error", "error", "no_batches"]
    assert first_json_text('x {"a": "\\"}"} y') == '{"a": "\\"}"}'
    assert list(balanced_objects('{a{b}} c {d} {e')) == ["{a{b}}", "{d}"]
    assert F is not None


def test_brace_fold_equals_the_plain_scan(spark):
    """``first_object`` against the Python scan, on texts of braces, quotes and escapes."""
    import random

    from taxograde.functions.json_text import _is_json, balanced_objects, first_object
    rng = random.Random(11)
    pieces = ['{', '}', '"', '"a": 1', '{"a": 1}', '{"b": "x } y"}', ' so ', '{"c": "\\\\" }', '{"d": "\\" }"}', ',', '{}', '\\', 'é中']
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(600)]
    texts += ["x " * 20_000 + '{"a": {"b": [1, {"c": "}"}]}}' + " y" * 20_000, "{" * 300, "}" * 300 + '{"a": 1}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = {r["i"]: r["o"] for r in df.select("i", first_object("t").alias("o")).collect()}
    for i, t in enumerate(texts):
        want = next(filter(_is_json, balanced_objects(t)), None)
        assert got[i] == want or _unclosed(t), (t, got[i], want)


def _unclosed(t):
    """A quote that is never closed inside an object: there the fold ends, the scan goes on."""
    import re
    at = t.find("{")
    while at >= 0:
        level = 0
        for m in re.finditer(r'"(?:[^"\\\\]|\\\\.)*"|["{}]', t[at:], re.S):
            if m[0] == '"':
                return True
            level += {"{": 1, "}": -1}.get(m[0], 0)
            if level == 0:
                break
        else:
            return False
        at = t.find("{", at + m.end())
    return False
