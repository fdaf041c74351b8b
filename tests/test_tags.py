import pytest

import wayposts as wp
from frames import by_key, posts, tuples


@pytest.fixture(scope="module")
def six(spark):
    return posts(
        spark,
        dict(owner="a", tags=["x", "y"], views=10),
        dict(owner="a", tags=["x", "y"], views=20),
        dict(owner="b", tags=["x"], views=100),
        dict(owner="b", tags=None, views=7),
        dict(owner="c", tags=[], views=5),
        dict(owner=None, tags=["x", "x"], views=1),
    )


def test_list_uses_count_empty_lists_but_not_null(six):
    assert by_key(wp.tag_list_stats(six)) == {
        ("x", "y"): (2, 15.0),
        ("x",): (1, 100.0),
        None: (0, 7.0),
        (): (1, 5.0),
        ("x", "x"): (1, 1.0),
    }


def test_lists_in_another_order_are_other_lists(spark):
    table = posts(spark, dict(tags=["x", "y"], views=1), dict(tags=["y", "x"], views=2))
    assert wp.tag_list_stats(table).count() == 2


def test_mean_of_list_means(six):
    # x: lists of mean 15, 100 and twice 1
    assert by_key(wp.tag_stats(six)) == {"x": (5, 29.25), "y": (2, 15.0)}


def test_weighted_mean_is_over_posts(six):
    assert by_key(wp.tag_stats(six, weighted=True)) == {"x": (5, 26.4), "y": (2, 15.0)}


def test_explode_drops_null_and_empty_lists_and_keeps_repeats(six):
    rows = sorted(tuples(wp.explode_tags(six)))
    assert rows == [(1, "x"), (1, "y"), (2, "x"), (2, "y"), (3, "x"), (6, "x"), (6, "x")]


def test_null_views_are_skipped_in_both_means(spark):
    table = posts(
        spark,
        dict(tags=["x"], views=None),
        dict(tags=["x"], views=None),
        dict(tags=["x", "y"], views=8),
        dict(tags=["x", "y"], views=None),
        dict(tags=["z"], views=None),
    )
    assert by_key(wp.tag_stats(table)) == {"x": (4, 8.0), "y": (2, 8.0), "z": (1, None)}
    # A tag without a mean comes last.
    assert [row[0] for row in tuples(wp.top_tags(table, by="mean_views"))] == ["x", "y", "z"]


def test_minimum_is_exclusive(six):
    assert tuples(wp.top_tags(six, min_exclusive=2)) == [("x", 5, 29.25)]
    assert len(tuples(wp.top_tags(six, min_exclusive=1))) == 2
    assert len(tuples(wp.top_tags(six))) == 2


def test_order_and_ties(spark):
    table = posts(
        spark, *[dict(tags=[tag], views=views) for tag, views in zip("dacb", (5, 5, 9, 1))]
    )
    assert [row[0] for row in tuples(wp.top_tags(table, 3))] == ["a", "b", "c"]
    assert [row[0] for row in tuples(wp.top_tags(table, 3, by="mean_views"))] == ["c", "a", "d"]


def test_chart_has_a_bar_per_tag_and_measure(six):
    bars = {(chart, label): value for chart, label, value in tuples(
        wp.tag_chart_data(wp.top_tags(six)))}
    assert bars == {
        ("count", "x"): 5.0,
        ("count", "y"): 2.0,
        ("mean_views", "x"): 29.25,
        ("mean_views", "y"): 15.0,
    }
