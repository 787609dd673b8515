"""Every registered query next to its SQL, on the smallest tables."""

import functools
import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from orderpulse.registry import frames

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module", autouse=True)
def shared_model_table():
    """The learner queries start from one model table: build it once for all of their tests."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frames, "model_data", functools.cache(frames.model_data))
        yield


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in SQL:
        problem = compare(got, duck.execute(SQL[name]).df())
        assert problem is None, problem
    else:
        assert len(got)


def test_entry_is_a_registered_query(spark):
    assert entry.entry(spark).count() == 5


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
