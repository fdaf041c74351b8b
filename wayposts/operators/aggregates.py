"""Aggregations. All of them combine on the map side, so a hot key costs no more than another."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def owner_popularity(posts: DataFrame) -> DataFrame:
    """Total views of each owner; posts without owner form one group."""
    return posts.groupBy("owner").agg(F.sum("views").alias("views"))


def owner_stats(posts: DataFrame) -> DataFrame:
    """Posts, mean views and latest post of each owner.

    ``num_post`` counts the owner values, so it is 0 for the group without owner.
    """
    return posts.groupBy("owner").agg(
        F.count("owner").alias("num_post"),
        F.avg("views").alias("mean_views"),
        F.max("datePosted").alias("lastPost"),
    )


def tag_list_stats(posts: DataFrame) -> DataFrame:
    """Uses and mean views of each tag list. Lists are equal if content and order are.

    A null list counts 0 uses, an empty list is a value like any other.
    """
    return posts.groupBy("tags").agg(
        F.count("tags").alias("count"), F.avg("views").alias("mean_views")
    )


def tag_stats(posts: DataFrame, weighted: bool = False) -> DataFrame:
    """Occurrences and mean views of each tag; a tag twice in a list occurs twice.

    By default the mean is that of the means of the distinct tag lists holding the tag, each
    list counting once per place of the tag in it. ``weighted`` takes the mean over the posts.
    """
    if weighted:
        tagged = posts.select(F.explode("tags").alias("tag"), "views")
        return tagged.groupBy("tag").agg(
            F.count(F.lit(1)).alias("count"), F.avg("views").alias("mean_views")
        )
    tagged = tag_list_stats(posts).select(F.explode("tags").alias("tag"), "count", "mean_views")
    return tagged.groupBy("tag").agg(
        F.sum("count").alias("count"), F.avg("mean_views").alias("mean_views")
    )


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per post and tag; posts with a null or empty list give none."""
    return posts.select("post_id", F.explode("tags").alias("tag"))


def global_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))


def second_highest(df: DataFrame, column: str) -> DataFrame:
    """The largest value below the maximum; no row if there is none.

    The maximum comes from a scalar subquery: two scans of one column that keep one value
    per task, where sorting or deduplicating would shuffle the column.
    """
    below = df.where(F.col(column) < global_max(df, column).scalar())
    return global_max(below, column).where(F.col(column).isNotNull())


def distinct_owners(posts: DataFrame, approx: bool = False) -> DataFrame:
    """The number of owners, with the lack of one counted as one more value.

    ``approx`` counts with a HyperLogLog sketch (2% standard error) instead of a shuffle of
    all the owners.
    """
    counted = (
        F.approx_count_distinct("owner", 0.02) if approx else F.count_distinct("owner")
    )
    unnamed = F.coalesce(F.max(F.col("owner").isNull().cast("long")), F.lit(0))
    return posts.agg((counted + unnamed).cast("long").alias("owners"))
