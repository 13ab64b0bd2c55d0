import pytest

from tests.parity import assert_equal, views
from tidemark.plans import COVERS, ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert_equal(spark, con, FOLDER, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_kernel_query_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_queries_name_what_they_cover():
    assert all(COVERS[n] for n in QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
