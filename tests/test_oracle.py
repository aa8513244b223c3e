"""Every query of the library itself against its SQL."""

import pytest

from cindergrid.plans import registry
from tests.compare import duck, rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
