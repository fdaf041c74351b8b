"""The contract of the entry module."""

import importlib.util
from pathlib import Path

import pytest


@pytest.fixture(scope="module")
def entry():
    path = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("__spark_entry__", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_flagship_query(spark, entry):
    users = entry.entry(spark)
    assert users.columns[0] == "owner"
    assert users.count() > 0


def test_every_query_of_the_library_has_sql(entry):
    assert entry.registered.queries().keys() <= entry.queries().keys()
    assert entry.registered.queries().keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert len(entry.registered.queries()) >= 70
