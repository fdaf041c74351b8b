import pytest
from pyspark.sql import functions as F

import wayposts as wp
from frames import by_key, day, posts, tuples
from wayposts.sources.shared_folder import materialize


def test_sketches_of_days_are_united(spark):
    rows = [dict(owner=f"o{i % 40}", datePosted=day(i % 7)) for i in range(280)]
    rows += [dict(owner=None, datePosted=day(3)), dict(owner=None, datePosted=day(90))]
    days = wp.owner_sketches(posts(spark, *rows), day=F.to_date("datePosted"))
    assert days.columns == ["day", "owners", "unnamed"] and days.count() == 8
    stored = materialize(days, "sketches")
    months = wp.united_owners(stored, month=F.month("day"))
    assert by_key(months) == {1: (41,), 3: (1,)}
    assert tuples(wp.united_owners(stored)) == [(41,)]


def test_a_later_day_adds_its_sketch(spark):
    first = wp.owner_sketches(posts(spark, dict(owner="a"), dict(owner="b")))
    second = wp.owner_sketches(posts(spark, dict(owner="b"), dict(owner="c"), dict(owner=None)))
    assert tuples(wp.united_owners(first.union(second))) == [(4,)]


def test_no_posts(spark):
    empty = posts(spark)
    assert tuples(wp.united_owners(wp.owner_sketches(empty))) == [(0,)]
    assert wp.united_owners(wp.owner_sketches(empty, day=F.to_date("datePosted"))).first()[0] == 0


@pytest.mark.parametrize("n", [1_000, 200_000])
def test_estimates_are_near(spark, n):
    table = spark.range(2 * n).selectExpr(f"cast(id % {n} as string) as owner", "id % 11 as slice")
    united = wp.united_owners(wp.owner_sketches(table, slice=F.col("slice")))
    assert united.first()[0] == pytest.approx(n, rel=0.05)
    sizes = wp.owner_sketches(table, slice=F.col("slice")).select(F.length("owners"))
    assert all(row[0] <= 2**13 for row in sizes.collect())
