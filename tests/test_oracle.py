"""Every registered query against its check SQL on the supplied tables."""

import os

import pytest

import __spark_entry__ as driver
import oracle
from cinderlake.catalog.registry import all_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    equal, message = oracle.compare(df, con, driver.oracle_sql()[name])
    assert equal, message


def test_every_query_has_check_sql():
    assert all(sql for _, sql in all_queries().values())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["min", "p25", "median", "p75", "max", "lau1_code", "year"] and df.count() > 0
