import os

import pytest

import __spark_entry__ as entry

from . import oracle
from strandframe.plans import fields, queries, repeats  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert oracle.difference(spark, oracle.connect(SF), SF, queries.QUERIES[name], queries.SQL[name]) is None


def test_entry():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(queries.QUERIES) <= set(entry.queries())
