"""Figures of the test tables that were worked out independently in two engines."""

import pytest

import wayposts as wp
from checks import fixtures
from frames import tuples

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return fixtures.posts_from_events(spark, SF_DIR)


def _start(df, rows):
    return [
        tuple(pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for v in row)
        for row in tuples(df)[:rows]
    ]


def test_top_tags(events):
    assert _start(wp.top_tags(events, 20, min_exclusive=3), 2) == [
        ("error", 2010, 4910.721466),
        ("t0", 2005, 4996.577623),
    ]
    assert _start(wp.top_tags(events, 20, by="mean_views", min_exclusive=3), 1) == [
        ("signup", 1998, 5174.290207)
    ]


def test_top_words(spark):
    documents = fixtures.posts_from_documents(spark, SF_DIR)
    assert _start(wp.top_tags(documents, 50), 1) == [("the", 12363, 7078.590639)]


def test_active_users(events):
    users = wp.active_users(events, 20).select("owner", "num_post", "mean_views")
    assert users.count() == 19
    assert _start(users, 2) == [("u78", 75, 6202.945946), ("u14", 62, 5288.096774)]


def test_routes(events):
    # The group without owner is second in popularity and takes one of the three places.
    assert wp.owner_route(events, 3, 10).count() == 20
    assert [row.owner for row in wp.popular_owners(events, 3).collect()] == ["u128", None, "u20"]


@pytest.mark.parametrize("scale, owners, positions, pairs", [
    ("0.001", 16, 70, 631), ("0.01", 151, 70, 6399), ("0.1", 1501, 70, 64123)])
def test_distinct_counts(spark, scale, owners, positions, pairs):
    events = fixtures.posts_from_events(spark, f"/root/testdata/sf{scale}")
    assert tuples(wp.distinct_owners(events)) == [(owners,)]
    assert wp.distinct_positions(events).count() == positions
    owned = events.where("owner is not null")
    assert wp.owner_distinct_positions(owned).count() == pairs
