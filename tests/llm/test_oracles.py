"""The queries of this subpackage that have SQL, against it."""

import pytest

from cindergrid.llm.oracles import ORACLES
from cindergrid.llm.queries import QUERIES
from tests.compare import duck, rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
