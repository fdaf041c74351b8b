"""Where the most popular owners have been: their latest posts at distinct positions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.arguments import whole_number
from wayposts.functions import palette_color, post_text
from wayposts.operators.distinct import (
    newest_first,
    newest_first_numbers,
    owner_distinct_positions,
)
from wayposts.operators.joining import join_ranked
from wayposts.operators.ranking import (
    numbered,
    sorted_report,
    top_per_group,
    top_rows,
    with_group_size,
)
from wayposts.plans.owners import most_viewed_first

_ROUTE = ("owner", "views", "latitude", "longitude", "dateTaken")
_PATH_ORDER = ("owner_index", "place")


def _stops(posts: DataFrame, n_users: int, n_posts: int) -> DataFrame:
    """The route rows with ``owner_index`` (0 = most popular) and ``place`` (1 = newest)."""
    # The group without owner may take one of the places; it has no route and no index.
    totals = posts.groupBy("owner").agg(
        F.sum("views").alias("views"), F.count("owner").alias("num_post")
    )
    popular = top_rows(totals, n_users, *most_viewed_first()).where(F.col("owner").isNotNull())
    indexed = numbered(popular, "owner_index", n_users, *most_viewed_first()).select(
        "owner", "num_post", (F.col("owner_index") - 1).alias("owner_index")
    )
    columns = posts.select("post_id", *_ROUTE)
    theirs = join_ranked(columns, indexed, "owner", n_users).drop("num_post")
    places = owner_distinct_positions(theirs, "owner_index")
    return top_per_group(
        places, ["owner"], newest_first(), n_posts, name="place", numbers=newest_first_numbers()
    )


def owner_route(posts: DataFrame, n_users: int = 3, n_posts: int = 10) -> DataFrame:
    """The last ``n_posts`` posts at distinct positions of the ``n_users`` most viewed owners.

    Owners come in order of popularity, their posts newest first.
    """
    n_users, n_posts = whole_number("n_users", n_users), whole_number("n_posts", n_posts)
    stops = _stops(posts, n_users, n_posts)
    return sorted_report(stops, n_users * n_posts, *map(F.col, _PATH_ORDER)).select(*_ROUTE)


def route_markers(posts: DataFrame, n_users: int = 3, n_posts: int = 10) -> DataFrame:
    """The map markers of ``owner_route``: ``seq`` is 1 at the oldest post of an owner."""
    n_users, n_posts = whole_number("n_users", n_users), whole_number("n_posts", n_posts)
    stops = with_group_size(_stops(posts, n_users, n_posts), ["owner"], "length", n_posts)
    markers = (
        stops.withColumn("seq", (F.col("length") - F.col("place") + 1).cast("int"))
        .withColumn("color", palette_color("owner_index"))
        .withColumn("info", post_text("owner", "dateTaken", "views"))
    )
    ordered = sorted_report(markers, n_users * n_posts, *map(F.col, _PATH_ORDER))
    return ordered.select(*_ROUTE, "seq", "color", "info")


def owner_view_counts(posts: DataFrame) -> DataFrame:
    """The posts of each owner that have a view count: ``owner, n_views``."""
    return posts.groupBy("owner").agg(F.count("views").alias("n_views"))
