"""Queries of the text subpackage that SQL can express give exactly the SQL engine's rows."""

import pytest

from comparing import connection, differences
from loyalscope.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    actual = queries.QUERIES[name](spark, SF_DIR).toArrow()
    assert differences(actual, connection(SF_DIR).sql(queries.ORACLES[name]).to_arrow_table()) == []
