"""Registered queries against their SQL, over whole tables."""

import pytest

from guestlens.llm.catalog import ORACLE, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), tables, ORACLE[name]) is None


def test_every_operator_is_registered_once():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in QUERIES
