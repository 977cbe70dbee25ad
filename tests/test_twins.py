"""Every registered query against its SQL twin at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, database  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from mercata.catalog import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    state, note, _, _ = compare(spark, con, SF, name)
    assert state == "ok", note


@pytest.mark.parametrize("name", ["sample_fixed", "split_stratified", "cleaning_run", "preprocess"])
def test_queries_without_twin_return_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_and_registry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
