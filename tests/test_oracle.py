"""Every registered query with an oracle agrees with DuckDB at sf0.001
(row count, column names, order-insensitive values)."""

import pytest

from conftest import SF001
from oracle_harness import compare, duck
from tabprep.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_pair(spark, con, name):
    n, problems = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    assert not problems, problems


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
