"""The dataset at a glance, and its positions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.arguments import whole_number
from wayposts.operators.aggregates import global_max
from wayposts.operators import ranking
from wayposts.operators.ranking import top_rows
from wayposts.operators.selection import nth_lowest
from wayposts.schema import POSITION


def dataset_shape(posts: DataFrame) -> DataFrame:
    """Numbers of rows and columns. The count reads file metadata, no column."""
    return posts.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(posts.columns))
    )


def preview_posts(posts: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` posts with the lowest ids, all columns, in the order of the ids.

    The last of the ids is found in scans of ``post_id`` alone. It then filters the scan of all
    columns, which skips the row groups that start above it.
    """
    n = whole_number("n", n)
    lowest = _lowest(posts, n)
    if n > ranking.REPORT_ROWS:
        return lowest.orderBy("post_id")
    return top_rows(lowest, n, F.col("post_id").asc())


def _lowest(posts: DataFrame, n: int) -> DataFrame:
    """The ``n`` posts with the lowest ids, as the table holds them.

    The highest of these ids filters the scan. For a long list it is found by counting ranges
    of ids, so no list of ids is moved.
    """
    if n <= ranking.REPORT_ROWS:
        ids = top_rows(posts.select("post_id"), n, F.col("post_id").asc())
        return posts.where(F.col("post_id") <= global_max(ids, "post_id").scalar())
    last = nth_lowest(posts.select("post_id"), "post_id", n)
    return posts if last is None else posts.where(F.col("post_id") <= last)


def lat_lon(posts: DataFrame) -> DataFrame:
    return posts.select(*POSITION)


def map_points(posts: DataFrame, n: int) -> DataFrame:
    """The positions of the ``n`` posts with the lowest ids, as the table holds them.

    The rows come in the order of a scan of the table, whatever ``n`` is; nothing is sorted.
    """
    return _lowest(posts, whole_number("n", n)).select(*POSITION)
