"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
import oracle_check as OC  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return OC.duck(SF)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["inner_id", "price", "km_age", "active_status", "change_type"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = OC.compare(E.queries()[name](spark, SF), con.sql(E.oracle_sql()[name]))
    assert ok, msg
