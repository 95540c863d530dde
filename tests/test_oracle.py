"""Every registered query against its SQL twin on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from lapakdw import registry
from oracle.queries import ORACLE
from tests.conftest import SF_SMALL
from tests.helpers import plan

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, ORACLE[name]) is None
    text = plan(df)
    assert not any(word in text for word in ("CartesianProduct", "NestedLoopJoin", "Python"))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["outlet", "tahun", "bulan"]
    assert df.count() > 0
