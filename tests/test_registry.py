"""Every registered query against its SQL, on the driver's tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from scenlens.workload.oracles import ORACLES
from scenlens.workload.queries import QUERIES
from tests.check_oracles import connect, difference

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
