"""Duplicates and unions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayposts.operators.ranking import top_per_group
from wayposts.operators.selection import descending, moment_number
from wayposts.schema import POSITION


def newest_first() -> list[Column]:
    return [F.col("dateTaken").desc_nulls_last(), F.col("post_id").asc()]


def newest_first_numbers() -> list[Column]:
    """The order of ``newest_first`` as whole numbers."""
    taken = F.coalesce(descending(moment_number("dateTaken")), F.lit(0))
    return [F.col("dateTaken").isNull().cast("long"), taken, F.col("post_id")]


def distinct_positions(posts: DataFrame) -> DataFrame:
    """One post per position: the last one taken. Posts without a position are left out."""
    placed = posts.select("post_id", *POSITION, "views", "dateTaken").where(
        " and ".join(f"{c} is not null and not isnan({c})" for c in POSITION)
    )
    newest = top_per_group(placed, POSITION, newest_first(), 1)
    return newest.select("post_id", *POSITION, "views")


def owner_distinct_positions(posts: DataFrame, *carried: str) -> DataFrame:
    """One post per owner and position: the last one taken, with the ``carried`` columns."""
    placed = posts.select("post_id", "owner", "views", *POSITION, "dateTaken", *carried)
    return top_per_group(placed, ["owner", *POSITION], newest_first(), 1)


def distinct_owner_values(posts: DataFrame) -> DataFrame:
    return posts.select("owner").distinct()


def union_posts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of tables with the same columns, duplicates kept."""
    return reduce(DataFrame.unionByName, others, first)


def empty_like(posts: DataFrame) -> DataFrame:
    return posts.limit(0)
