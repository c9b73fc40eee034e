"""Every query of the catalog against its SQL on the smallest driver tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_module
from platewise import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    con.execute("SET TimeZone = 'UTC'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    sql = entry_module.oracle_sql().get(name)
    rows = df.collect()
    assert sql is not None
    assert differences(rows, df.columns, duck.execute(sql)) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
