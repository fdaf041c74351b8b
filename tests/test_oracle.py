"""Each registered query against its SQL on the same tables."""

import duckdb
import pytest

from checks import oracle, queries

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '{SF_DIR}/{table}.parquet'"
        )
    return connection


def _sortable(row):
    return tuple((value is not None, str(value)) for value in row)


def _same(ours, theirs):
    return type(ours) is type(theirs) and ours == theirs


def test_every_query_has_sql():
    assert queries.queries().keys() == oracle.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_equal(spark, database, name):
    result = queries.queries()[name](spark, SF_DIR)
    cursor = database.execute(oracle.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    ours = sorted(map(tuple, result.select(*[f"`{c}`" for c in columns]).collect()), key=_sortable)
    theirs = sorted(cursor.fetchall(), key=_sortable)
    assert len(ours) == len(theirs)
    wrong = [
        (one, other)
        for one, other in zip(ours, theirs)
        if not all(map(_same, one, other))
    ]
    assert not wrong, wrong[:3]
