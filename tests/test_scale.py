"""Results with hot keys and on the ways taken beyond the size limits."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import wayposts as wp
from frames import day, posts, tuples
from wayposts.operators import joining, ranking, selection
from wayposts.operators.ranking import sorted_report, top_per_group

_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


@pytest.fixture
def no_group_limit(spark):
    before = spark.conf.get(_LIMIT)
    spark.conf.set(_LIMIT, "0")
    yield
    spark.conf.set(_LIMIT, before)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joining, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def skewed_rows():
    """Posts of which two thirds have one owner, and half of those one position and list."""
    chance = random.Random(7)
    rows = []
    for _ in range(3000):
        hot = chance.random() < 2 / 3
        still = hot and chance.random() < 0.5
        rows.append(
            dict(
                owner="hot" if hot else chance.choice(["a", "b", "c", "d", None]),
                datePosted=day(chance.randrange(400)),
                dateTaken=chance.choice([None, day(chance.randrange(400))]),
                views=chance.choice([None, chance.randrange(1000)]),
                tags=["x", "y"] if still else chance.choice(
                    [None, [], ["x"], ["y", "x"], ["z", "z"], ["y"]]
                ),
                latitude=1.0 if still else float(chance.randrange(6)),
                longitude=1.0 if still else float(chance.randrange(9)),
            )
        )
    return rows


@pytest.fixture(scope="module")
def skewed(spark, skewed_rows):
    return posts(spark, *skewed_rows).repartition(7)


def _newest_key(row):
    taken = row["dateTaken"]
    return (taken is None, -taken.timestamp() if taken else 0, row["post_id"])


def _expected_route(rows, n_users, n_posts):
    rows = [{**row, "post_id": i} for i, row in enumerate(rows, 1)]
    totals = {}
    for row in rows:
        before = totals.setdefault(row["owner"], None)
        if row["views"] is not None:
            totals[row["owner"]] = (before or 0) + row["views"]
    ranked = sorted(
        totals, key=lambda o: (totals[o] is None, -(totals[o] or 0), o is not None, o or "")
    )
    route = []
    for owner in ranked[:n_users]:
        if owner is None:
            continue
        newest = {}
        for row in sorted((r for r in rows if r["owner"] == owner), key=_newest_key):
            newest.setdefault((row["latitude"], row["longitude"]), row)
        stops = sorted(newest.values(), key=_newest_key)[:n_posts]
        route += [
            tuple(row[c] for c in ("owner", "views", "latitude", "longitude", "dateTaken"))
            for row in stops
        ]
    return route


def _expected_tags(rows):
    lists = {}
    for row in rows:
        if row["tags"]:
            lists.setdefault(tuple(row["tags"]), []).append(row["views"])
    tags = {}
    for tag_list, views in lists.items():
        known = [v for v in views if v is not None]
        for tag in tag_list:
            count, means = tags.setdefault(tag, [0, []])
            tags[tag][0] = count + len(views)
            means += [sum(known) / len(known)] if known else []
    return {
        tag: (count, pytest.approx(sum(means) / len(means)) if means else None)
        for tag, (count, means) in tags.items()
    }


def _expected_users(rows, n):
    owners = {}
    for row in rows:
        owners.setdefault(row["owner"], []).append(row)
    latest = {
        owner: max((r["datePosted"] for r in theirs if r["datePosted"]), default=None)
        for owner, theirs in owners.items()
    }
    ranked = sorted(
        owners,
        key=lambda o: (
            latest[o] is None, -latest[o].timestamp() if latest[o] else 0, o is not None, o or ""
        ),
    )
    users = []
    for place, owner in enumerate(ranked[:n], 1):
        if owner is None:
            continue
        uses = {}
        for row in owners[owner]:
            key = None if row["tags"] is None else tuple(row["tags"])
            uses[key] = uses.get(key, 0) + (key is not None)
        best = min(uses, key=lambda t: (-uses[t], t is None, t or ()))
        users.append(
            (place, owner, len(owners[owner]), None if best is None else list(best), uses[best])
        )
    return users


def _users(table, n):
    return tuples(wp.active_users(table, n).select("id", "owner", "num_post", "tags", "tag_uses"))


def test_hot_owner(skewed, skewed_rows):
    assert tuples(wp.owner_route(skewed, 4, 12)) == _expected_route(skewed_rows, 4, 12)
    assert _users(skewed, 6) == _expected_users(skewed_rows, 6)


def test_hot_list(skewed, skewed_rows):
    found = {row.tag: (row["count"], row.mean_views) for row in wp.tag_stats(skewed).collect()}
    assert found == _expected_tags(skewed_rows)


def test_long_owner_lists_are_joined_without_broadcast(skewed, skewed_rows, no_broadcast):
    route = wp.owner_route(skewed, 4, 12)
    plan = route._jdf.queryExecution().executedPlan().toString()
    # only the owners that hold more than a partition's share are broadcast
    assert plan.count("BroadcastHashJoin") == 1 and "_slice" in plan
    assert tuples(route) == _expected_route(skewed_rows, 4, 12)
    assert _users(skewed, 6) == _expected_users(skewed_rows, 6)


def test_a_long_list_is_copied_by_the_share_of_each_owner(spark, no_broadcast):
    table = wp.union_posts(
        posts(spark, *[dict(owner="hot") for _ in range(60)]),
        posts(spark, *[dict(owner=f"o{i}") for i in range(20)]),
    )
    ranked = table.groupBy("owner").agg(F.count("owner").alias("num_post"))
    joined = joining.join_ranked(table.select("post_id", "owner"), ranked, "owner", 10**7)
    assert joined.columns == ["owner", "post_id", "num_post"]
    assert joined.count() == 80
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(owner" in plan and "_slice" in plan


def test_large_limits_are_numbered_across_partitions(skewed, skewed_rows, no_group_limit):
    route = wp.owner_route(skewed, 4, 12)
    plan = route._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan
    assert tuples(route) == _expected_route(skewed_rows, 4, 12)
    markers = wp.route_markers(skewed, 4, 12).collect()
    assert [tuple(row)[:5] for row in markers] == _expected_route(skewed_rows, 4, 12)
    assert _users(skewed, 6) == _expected_users(skewed_rows, 6)
    copies = wp.union_posts(skewed, *[skewed.where("post_id = 5")] * 40)
    assert wp.clean_posts(copies, ["post_id"]).count() == 3000


@pytest.mark.parametrize("n", [3, 200, 1500])
def test_top_of_large_groups(skewed, n, no_group_limit):
    order = [F.col("views").desc_nulls_last(), F.col("post_id")]
    top = top_per_group(skewed, ["owner"], order, n, name="place")
    found = {}
    for row in top.select("owner", "place", "post_id").orderBy("owner", "place").collect():
        found.setdefault(row.owner, []).append((row.place, row.post_id))
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row.owner, []).append((row.views is None, -(row.views or 0), row.post_id))
    assert found == {
        owner: [(place, key[2]) for place, key in enumerate(sorted(keys)[:n], 1)]
        for owner, keys in groups.items()
    }


def test_a_large_group_is_spread_over_tasks(spark, no_group_limit):
    rows = spark.range(80_000).select(
        F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id") % 97).otherwise(-1).alias("key")
    )
    top = top_per_group(rows, ["key"], [F.col("id").desc()], 50_000, name="place")
    hot = top.where("key = -1")
    assert hot.count() == 50_000 and hot.agg(F.max("place")).first()[0] == 50_000
    parts = hot.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert parts[0] <= 25_000 and parts[1] >= 3


def test_numbers_of_rows(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    numbers = ranking.number_rows(rows, "n", F.col("x").desc())
    assert numbers.where("n <> 5000 - x").count() == 0 and numbers.count() == 5000
    assert selection.nth_lowest(rows, "x", 1) == 0
    assert selection.nth_lowest(rows, "x", 4321) == 4320
    assert selection.nth_lowest(rows, "x", 5001) is None


def test_lists_of_any_length(skewed):
    assert tuples(wp.map_points(skewed, 2**31)) == tuples(wp.lat_lon(skewed))
    assert wp.map_points(skewed, 2500).count() == 2500
    assert [r.post_id for r in wp.preview_posts(skewed, 2500).collect()] == list(range(1, 2501))
    assert tuples(wp.popular_owners(skewed, 2**40)) == tuples(wp.popular_owners(skewed, 100))
    assert _users(skewed, 2**33) == _users(skewed, 100)
    many = wp.top_tags(skewed, 2**35)
    assert tuples(many) == tuples(wp.top_tags(skewed, 50))


def test_limits_above_the_size_of_groups_keep_them_whole(skewed, no_group_limit):
    order = [F.col("views").desc_nulls_last(), F.col("post_id")]
    top = top_per_group(skewed, ["owner"], order, 1_000_000, name="place")
    assert top.count() == 3000
    assert top.where("place = 1").count() == 6


def test_long_reports_are_sorted_by_range(skewed, monkeypatch):
    short = tuples(sorted_report(skewed, 3000, F.col("post_id")))
    monkeypatch.setattr(ranking, "REPORT_ROWS", 10)
    report = sorted_report(skewed, 3000, F.col("post_id"))
    assert "TakeOrdered" not in report._jdf.queryExecution().executedPlan().toString()
    assert tuples(report) == short


_ROWS = st.lists(
    st.fixed_dictionaries(
        dict(
            owner=st.sampled_from(["a", "b", "c", None]),
            datePosted=st.sampled_from([None, day(1), day(2), day(3)]),
            dateTaken=st.sampled_from([None, day(1), day(2), day(3)]),
            views=st.one_of(st.none(), st.integers(0, 9)),
            tags=st.one_of(st.none(), st.lists(st.sampled_from("xyz"), max_size=2)),
            latitude=st.sampled_from([None, 0.0, 1.0]),
            longitude=st.sampled_from([None, 0.0, 1.0]),
        )
    ),
    max_size=25,
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=_ROWS, n=st.integers(1, 4), m=st.integers(1, 4))
def test_against_plain_python(spark, rows, n, m):
    table = posts(spark, *rows)
    assert tuples(wp.owner_route(table, n, m)) == _expected_route(rows, n, m)
    assert _users(table, n) == _expected_users(rows, n)
    found = {row.tag: (row["count"], row.mean_views) for row in wp.tag_stats(table).collect()}
    assert found == _expected_tags(rows)
