"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from marquetry.checks.registry import ORACLES
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry_is_the_gold_table(spark):
    gold = entry.entry(spark)
    assert len(gold.columns) == 26
    assert gold.count() == gold.select("tconst").distinct().count() > 0
