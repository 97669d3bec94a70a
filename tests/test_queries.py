"""Every registered query against its SQL on an independent engine, and the driver contract."""

import pytest

import __spark_entry__ as entry
from lithosense.registry import ORACLES, QUERIES
from tests.oracle_check import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf, name):
    ok, message = compare(QUERIES[name](spark, sf), duck, ORACLES[name])
    assert ok, message


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns[0] == "week_start" and df.count() > 0
