import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, ids string, score double"

#: Nulls in every column, empty, blank and long texts, ties, repeated rows, a null id.
AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 1, 0, "x", 0.5),
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 1, 0, "x", 0.5),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", "s", 0, 1, "", 0.0),
    (4, " \n\t ", "fr", "s", 4, 1, "", 0.0),
    (None, "a text without an id, with token = abcdefgh12345678", None, "s", 1, 1, "", 0.0),
    (5, "word " * 60_000, "en", "s", 300_000, 1, "", 0.0),
    (6, "!!! ### 123 \U0001F642", "es", "s", 13, 1, "", 0.0),
    (-7, "alpha beta gamma delta epsilon zeta eta theta", "en", "t", 1, 0, "x", 0.5),
]


@pytest.fixture(scope="session")
def spark():
    from taxograde.session import get_session
    yield get_session("local[4]", shuffle_partitions=4)


@pytest.fixture()
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]
