"""Joins of the posts with a short ranked list, and with a second version of themselves."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.operators.ranking import shuffle_partitions
from wayposts.sources.shared_folder import materialize

# A list of at most this many rows (an owner's name and a few numbers each) is broadcast.
BROADCAST_ROWS = 10_000


def join_ranked(posts: DataFrame, ranked: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join of the posts with ``ranked``: ``rows`` rows at most, ``key`` unique.

    ``ranked`` has ``num_post``, the number of posts of each key. The posts are not shuffled
    when the list is short enough to broadcast. Otherwise both sides are dealt out by ``key``,
    and a key that holds more than a partition's share of the posts by a slice number too: as
    many slices as the shares it holds, so all the copies together are at most one more row
    per partition.
    """
    if rows <= BROADCAST_ROWS:
        return posts.join(F.broadcast(ranked), key, "inner")
    ranked = materialize(ranked, "ranked")
    total = ranked.agg(F.sum("num_post")).first()[0] or 1
    shares = F.ceil(F.col("num_post") * shuffle_partitions(posts.sparkSession) / total)
    sliced = ranked.withColumn("_slices", F.greatest(shares, F.lit(1)))
    # every one of these holds more than one share, so there are fewer than partitions
    large = sliced.where("_slices > 1").select(key, "_slices")
    place = F.pmod(F.xxhash64("post_id"), F.coalesce("_slices", F.lit(1)))
    spread = posts.join(F.broadcast(large), key, "left").withColumn("_slice", place)
    copies = sliced.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1))
    )
    joined = spread.drop("_slices").join(copies.drop("_slices"), [key, "_slice"], "inner")
    return joined.drop("_slice")


def repair_column(posts: DataFrame, typed: DataFrame, column: str = "tags") -> DataFrame:
    """``posts`` with ``column`` taken from ``typed``, matched by the unique ``post_id``.

    All posts are kept; one that ``typed`` lacks gets null. A ``post_id`` that ``typed`` has
    several times with one value counts once; with different values, a null among them, it is an
    error when the result is computed. The check uses the shuffle of the join.
    """
    columns = posts.columns if column in posts.columns else [*posts.columns, column]
    value = F.col(column)
    counted = typed.groupBy("post_id").agg(
        F.min(value).alias("_lowest"),
        F.max(value).alias("_highest"),
        F.count(value).isin(0, F.count(F.lit(1))).alias("_alike"),
    )
    one = F.col("_alike") & F.col("_lowest").eqNullSafe(F.col("_highest"))
    text = F.format_string(f"the typed table has post_id %s with different {column}", F.col("post_id"))
    fixed = counted.select(
        "post_id", F.when(one, F.col("_lowest")).otherwise(F.raise_error(text)).alias(column)
    )
    return posts.drop(column).join(fixed, "post_id", "left").select(*columns)
