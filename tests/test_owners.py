import wayposts as wp
from frames import by_key, day, posts, tuples


def _table(spark):
    return posts(
        spark,
        dict(owner="a", datePosted=day(1), views=10, tags=["x"]),
        dict(owner="a", datePosted=day(5), views=None, tags=["x"]),
        dict(owner="a", datePosted=day(2), views=30, tags=["y"]),
        dict(owner=None, datePosted=day(9), views=500, tags=["z"]),
        dict(owner="b", datePosted=day(5), views=40, tags=["q", "p"]),
        dict(owner="b", datePosted=day(3), views=None, tags=["p", "q"]),
        dict(owner="c", datePosted=None, views=None, tags=None),
        dict(owner="d", datePosted=day(4), views=41, tags=None),
        dict(owner="d", datePosted=day(4), views=0, tags=[]),
    )


def test_group_without_owner_counts_no_posts(spark):
    stats = by_key(wp.owner_stats(_table(spark)))
    assert stats[None] == (0, 500.0, day(9))
    assert stats["a"] == (3, 20.0, day(5))
    assert stats["c"] == (1, None, None)


def test_ranked_by_latest_post_then_owner(spark):
    ranked = tuples(wp.active_users_ranked(_table(spark), 4).select("id", "owner"))
    assert ranked == [(1, None), (2, "a"), (3, "b"), (4, "d")]
    assert tuples(wp.active_users_ranked(_table(spark), 9).select("owner"))[-1] == ("c",)


def test_missing_owner_takes_a_place_but_gives_no_row(spark):
    users = tuples(wp.active_users(_table(spark), 3))
    assert [(row[0], row[4]) for row in users] == [("a", 2), ("b", 3)]


def test_most_used_list(spark):
    users = {row.owner: row for row in wp.active_users(_table(spark), 9).collect()}
    assert (users["a"].tags, users["a"].tag_uses) == (["x"], 2)
    # Equal uses: the list that sorts first.
    assert (users["b"].tags, users["b"].tag_uses) == (["p", "q"], 1)
    # A null list counts no use, so any list wins over it.
    assert (users["c"].tags, users["c"].tag_uses) == (None, 0)
    assert (users["d"].tags, users["d"].tag_uses) == ([], 1)


def test_columns(spark):
    assert wp.active_users(_table(spark), 9).columns == [
        "owner", "num_post", "mean_views", "lastPost", "id", "tags", "tag_uses"
    ]


def test_list_counts_and_top_list_agree_with_the_report(spark):
    table = _table(spark)
    uses = {
        (row.owner, None if row.tags is None else tuple(row.tags)): row.tag_uses
        for row in wp.owner_tag_list_counts(table, 9).collect()
    }
    assert uses[("a", ("x",))] == 2 and uses[("d", None)] == 0 and uses[("d", ())] == 1
    report = wp.active_users(table, 9).select("owner", "tags", "tag_uses")
    assert sorted(map(str, tuples(report))) == sorted(
        map(str, tuples(wp.owner_top_tag_list(table, 9)))
    )


def test_popularity(spark):
    assert tuples(wp.popular_owners(_table(spark), 4)) == [
        (None, 500), ("d", 41), ("a", 40), ("b", 40)
    ]
    assert by_key(wp.owner_popularity(_table(spark)))["c"] == (None,)


def test_posts_of_an_owner(spark):
    table = _table(spark)
    assert wp.owner_posts(table, "a").count() == 3
    assert wp.owner_posts(table, None).count() == 0


def test_chart_labels(spark):
    bars = {(row.chart, row.label): row.value for row in wp.owner_chart_data(
        wp.active_users(_table(spark), 3)).collect()}
    assert bars == {
        ("num_post", "U2"): 3.0,
        ("num_post", "U3"): 2.0,
        ("mean_views", "U2"): 20.0,
        ("mean_views", "U3"): 40.0,
    }
