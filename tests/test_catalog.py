"""Every catalogue query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, duck
from places import SMALL

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SMALL), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_has_rows(spark, name):
    assert queries()[name](spark, SMALL).limit(1).count() == 1


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5 and all(r["n"] > 0 for r in rows)
