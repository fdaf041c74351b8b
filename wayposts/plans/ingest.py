"""From a CSV export to the table the queries read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayposts.operators.joining import repair_column
from wayposts.schema import POSTS_SCHEMA, REQUIRED_COLUMNS
from wayposts.sources.cleaning import clean_posts
from wayposts.sources.csv_posts import read_csv_posts


def load_posts(
    spark: SparkSession,
    csv_path: str,
    typed_tags: DataFrame | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read, repair and clean an export.

    The text of the tag lists is parsed, unless ``typed_tags`` (``post_id, tags``, one row per
    post) gives them as arrays. Columns that the export may lack and does are null, ids are
    numbers then. Write the result as parquet once and run the queries on that.
    """
    raw = read_csv_posts(spark, csv_path, multiline)
    if typed_tags is None:
        return _whole(clean_posts(raw))
    if "post_id" not in raw.columns:
        raise ValueError("typed tags are matched by post_id, which the export lacks")
    # All copies of a post get the same tags, so the copies are dropped before the join: it
    # then meets no post twice, and finds the posts partitioned by its key.
    others = [column for column in REQUIRED_COLUMNS if column != "tags"]
    posts = repair_column(clean_posts(raw.drop("tags"), others), typed_tags)
    return _whole(posts.dropna(subset=["tags"]))


def _whole(posts: DataFrame) -> DataFrame:
    """``posts`` with all the columns of the schema, in its order."""
    return posts.select(
        *[
            F.col(f.name) if f.name in posts.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in POSTS_SCHEMA
        ]
    )
