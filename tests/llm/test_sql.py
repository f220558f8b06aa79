"""Every document query with a SQL statement gives the same rows as the other engine."""

import os

import pytest

import __spark_entry__ as entry
from tests.comparing import differences
from trackmart.llm.registry import QUERIES, STATEMENTS

FOLDER = os.environ.get("TRACKMART_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name], STATEMENTS[name], spark, FOLDER) is None


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(STATEMENTS) <= set(entry.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
