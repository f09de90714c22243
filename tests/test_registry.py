"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from tests.compare import connect, differences

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir_module):
    return connect(sf_dir_module)


@pytest.fixture(scope="module")
def sf_dir_module():
    return "/root/testdata/sf0.001"


def test_sql_names_are_queries():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, registry.queries()[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert registry.entry(spark).count() == 24
