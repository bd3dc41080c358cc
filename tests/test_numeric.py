"""Exact rounding (Python round on the double) and token estimates."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxograde.functions.numeric import item_tokens, text_tokens, with_py_round
from taxograde.operators.batching import token_budget


def test_round_matches_python(spark):
    vals = [a / n for n in range(1, 120) for a in range(0, n + 1)] + [0.00005, 1 / 32, 3 / 32, 0.7 + 0.2 * 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = with_py_round(df, {"r4": ("x", 4), "r3": ("x", 3)}).collect()
    for r in rows:
        assert r["r4"] == round(r["x"], 4)
        assert r["r3"] == round(r["x"], 3)


def test_round_exhaustive_rates_and_confidence(spark):
    """Every a/n for n <= 400 and every confidence 0.7 + 0.2 * (a/n + b/n) for
    n <= 60, computed in Spark, rounded in Spark, equal to Python's round."""
    rates = (spark.range(1, 401).withColumnRenamed("id", "n")
             .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("n"))))
             .withColumn("x", F.col("a") / F.col("n")))
    rates = with_py_round(rates, {"r": ("x", 4)})
    assert all(r.r == round(r.a / r.n, 4) for r in rates.collect())
    conf = (spark.range(1, 61).withColumnRenamed("id", "n")
            .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("n"))))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("a"))))
            .withColumn("c", F.lit(0.7) + F.lit(0.2) * (F.col("a") / F.col("n")
                                                        + F.col("b") / F.col("n"))))
    conf = with_py_round(conf, {"r": ("c", 3)})
    assert all(r.r == round(0.7 + 0.2 * (r.a / r.n + r.b / r.n), 3) for r in conf.collect())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=200, max_size=2000))
def test_round_random_doubles(spark, xs):
    xs = xs + [k / 4096 for k in range(4097)]  # dyadic values, including exact ties
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in with_py_round(df, {"r4": ("x", 4), "r3": ("x", 3)}).collect():
        assert r.r4 == round(r.x, 4) and r.r3 == round(r.x, 3), r.x


def test_tokens(spark):
    df = spark.createDataFrame([("", "a" * 7), ("ab", "x" * 8000)], "t string, a string")
    rows = df.select(text_tokens("t").alias("tt"), item_tokens("t", "a").alias("it")).collect()
    assert rows[0]["tt"] == 0 and rows[0]["it"] == 0 + 2 + 12
    assert rows[1]["tt"] == 1 and rows[1]["it"] == 1 + int(8000 / 3.5) + 12


def test_budget():
    assert token_budget(128000) == 69250
    assert token_budget(2000) == 0


def test_round_outside_unit_interval_is_null(spark):
    df = spark.createDataFrame([(-0.1,), (1.5,), (None,), (1.0,), (0.0,)], "x double")
    got = [r.r for r in with_py_round(df, {"r": ("x", 4)}).collect()]
    assert got == [None, None, None, 1.0, 0.0]
