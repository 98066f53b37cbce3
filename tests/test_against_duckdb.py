"""Every registered query against its DuckDB counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare.compare(spark, con, SF_DIR, name) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["tipo", "codigo", "descricao"]
