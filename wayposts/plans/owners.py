"""Owners: the most popular, the most recently active, and the tag list each uses most."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayposts.arguments import whole_number
from wayposts.operators.aggregates import owner_popularity, owner_stats
from wayposts.operators.joining import join_ranked
from wayposts.operators.ranking import numbered, sorted_report, top_per_group, top_rows

_RANKED = ("owner", "num_post", "mean_views", "lastPost", "id")


def owner_posts(posts: DataFrame, owner: str | None) -> DataFrame:
    """The posts of one owner; none for a null owner."""
    return posts.where(F.col("owner") == F.lit(owner))


def popular_owners(posts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` owners with the most views in total: ``owner, views``."""
    n = whole_number("n", n)
    return top_rows(owner_popularity(posts), n, *most_viewed_first())


def most_viewed_first() -> list[Column]:
    return [F.col("views").desc_nulls_last(), F.col("owner").asc()]


def active_users_ranked(posts: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` owners with the latest posts, numbered from 1 in ``id``.

    Posts without owner compete as one group.
    """
    n = whole_number("n", n)
    order = [F.col("lastPost").desc_nulls_last(), F.col("owner").asc()]
    return numbered(top_rows(owner_stats(posts), n, *order), "id", n, *order)


def _tag_list_uses(posts: DataFrame, n: int) -> DataFrame:
    # The ranked columns travel with the groups: taking them from a second use of the ranking
    # would run the aggregation of all the owners twice.
    ranked = active_users_ranked(posts, n)
    tagged = join_ranked(posts.select("post_id", "owner", "tags"), ranked, "owner", n)
    return tagged.groupBy(*_RANKED, "tags").agg(F.count("tags").alias("tag_uses"))


def _most_used(uses: DataFrame) -> DataFrame:
    order = [F.col("tag_uses").desc(), F.col("tags").asc_nulls_last()]
    return top_per_group(uses, ["owner"], order, 1)


def owner_tag_list_counts(posts: DataFrame, n: int = 20) -> DataFrame:
    """How often each of the ``n`` most recently active owners uses each tag list."""
    n = whole_number("n", n)
    return _tag_list_uses(posts, n).select("owner", "tags", "tag_uses")


def owner_top_tag_list(posts: DataFrame, n: int = 20) -> DataFrame:
    """The tag list each of the ``n`` most recently active owners uses most."""
    n = whole_number("n", n)
    return _most_used(_tag_list_uses(posts, n)).select("owner", "tags", "tag_uses")


def active_users(posts: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most recently active owners with their figures and most used tag list.

    Posts without owner may take one of the ``n`` places; they give no row.
    """
    n = whole_number("n", n)
    users = _most_used(_tag_list_uses(posts, n)).select(*_RANKED, "tags", "tag_uses")
    return sorted_report(users, n, F.col("id").asc())
