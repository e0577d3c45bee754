"""Every query with an SQL equivalent gives exactly the SQL engine's rows."""

import pytest

import __spark_entry__
from loyalscope.catalogue import ORACLES
from comparing import connection, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, con, name):
    actual = __spark_entry__.queries()[name](spark, SF_DIR).toArrow()
    assert differences(actual, con.sql(ORACLES[name]).to_arrow_table()) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(__spark_entry__.queries())


def test_flagship_query(spark):
    assert __spark_entry__.entry(spark).count() == 3
