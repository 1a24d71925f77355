"""Every query of the subpackage that has SQL, against it, on the driver's tables."""

import pytest

import __spark_entry__ as entry
from scenlens.llm.oracles import ORACLES
from scenlens.llm.queries import QUERIES
from tests.check_oracles import connect, difference

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"}
    assert numbers == set(range(1, 11)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), name, SF) is None
