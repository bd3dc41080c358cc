"""Every registered query against its DuckDB oracle (rows-only when none)."""

import pytest

import __spark_entry__ as E
from oracle_check import digest, duck_rows

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    assert rows, name
    if name in ORACLES:
        dcols, drows = duck_rows(SF_SMALL, ORACLES[name])
        assert sorted(cols) == sorted(dcols)
        assert len(rows) == len(drows)
        assert digest(rows, cols)[0] == digest(drows, dcols)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
