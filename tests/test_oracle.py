"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001 here to stay quick; ``python tests/oracle_compare.py`` runs sf0.01."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001
from tests.oracle_compare import compare, duck

from precinct.plans import catalog

KEYS = list(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF0001, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "crime_total", "rank"]
    assert df.count() > 0
