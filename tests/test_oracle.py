"""Every query with a SQL statement gives the same rows as the other engine."""

import os

import pytest

from tests.comparing import differences
from trackmart.plans import oracle, registry

FOLDER = os.environ.get("TRACKMART_TESTDATA", "/root/testdata/sf0.001")
STATEMENTS = oracle.statements()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, name):
    assert differences(registry.registered()[name], STATEMENTS[name], spark, FOLDER) is None


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(registry.registered())
