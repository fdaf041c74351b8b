"""Numbers of owners from sketches that are stored once per slice of the posts and then united.

A new day of posts adds one sketch; the number of owners of any set of days comes from their
sketches, without another look at the posts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers of a sketch as a power of two; the standard error is about 1.04 / 2 ** (12 / 2), 1.6%.
SKETCH_BITS = 12


def owner_sketches(posts: DataFrame, **by: Column) -> DataFrame:
    """One row per slice: the columns ``by``, an ``owners`` sketch of bounded size, and
    ``unnamed``, whether a post without owner is among them. Combined on the map side."""
    slices = [column.alias(name) for name, column in by.items()]
    return posts.groupBy(*slices).agg(
        F.hll_sketch_agg("owner", F.lit(SKETCH_BITS)).alias("owners"),
        F.max(F.col("owner").isNull()).alias("unnamed"),
    )


def united_owners(sketches: DataFrame, **by: Column) -> DataFrame:
    """About how many owners each larger slice has, the lack of one counted as one more:
    the columns ``by`` and ``owners``. Without ``by``, one row for all; 0 if there is no sketch."""
    slices = [column.alias(name) for name, column in by.items()]
    owners = F.hll_sketch_estimate(F.hll_union_agg("owners")) + F.max(F.col("unnamed").cast("long"))
    return sketches.groupBy(*slices).agg(F.coalesce(owners, F.lit(0)).cast("long").alias("owners"))
