"""Every registered query against its SQL check, over whole tables."""

import os
import shutil
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from guestlens.plans.catalog import ORACLE, QUERIES
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    assert differences(queries()[name](spark, FOLDER), tables, oracle_sql()[name]) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_entry_works_without_the_corpus_part(tmp_path):
    """The optional part may be absent; then the other queries remain."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    away = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(top, tmp_path / "repo", ignore=away)
    code = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    shown = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert shown.stdout.strip() == f"{sorted(QUERIES)} {sorted(ORACLE)}", shown.stderr
