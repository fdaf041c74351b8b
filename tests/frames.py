"""Small tables of posts for tests."""

import datetime as dt

from wayposts.schema import POSTS_SCHEMA
from wayposts.sources.tables import literal_frame


def day(number: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=number)


def posts(spark, *rows: dict):
    """Posts with the given values, ids counted from 1, and null elsewhere."""
    values = [
        [row.get(name, number if name == "post_id" else None) for name in POSTS_SCHEMA.names]
        for number, row in enumerate(rows, start=1)
    ]
    return literal_frame(spark, values, POSTS_SCHEMA)


def tuples(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def by_key(df) -> dict:
    """The rows by their first column; a list there becomes a tuple."""

    def hashable(value):
        return tuple(value) if isinstance(value, list) else value

    return {hashable(row[0]): tuple(row[1:]) for row in df.collect()}
