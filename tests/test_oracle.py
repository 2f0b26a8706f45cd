"""Every query with SQL gives the same schema, rows and values in both engines."""

import pytest

from compare import connect, differences
from gleaner.plans.oracle import ORACLE
from gleaner.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_as_sql(spark, sf, con, name):
    assert differences(con, QUERIES[name](spark, sf), ORACLE[name]) == []
