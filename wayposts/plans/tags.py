"""The most used and the most viewed tags."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.arguments import one_of, whole_number
from wayposts.operators.aggregates import tag_stats
from wayposts.operators.ranking import top_rows


def top_tags(
    posts: DataFrame,
    n: int = 20,
    by: str = "count",
    min_exclusive: int | None = None,
    weighted: bool = False,
) -> DataFrame:
    """The ``n`` first tags by occurrences or by mean views: ``tag, count, mean_views``.

    ``min_exclusive`` leaves out the tags that occur that many times or fewer.
    """
    n = whole_number("n", n)
    one_of("by", by, ("count", "mean_views"))
    tags = tag_stats(posts, weighted)
    if min_exclusive is not None:
        least = whole_number("min_exclusive", min_exclusive)
        tags = tags.where(F.col("count") > least)
    return top_rows(tags, n, F.col(by).desc_nulls_last(), F.col("tag").asc())
