"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
from muniment.plans.queries import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in ORACLE
    assert compare.difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns and df.take(1)
