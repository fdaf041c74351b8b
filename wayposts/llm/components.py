"""Connected components by alternating large and small stars, without a vertex in one place."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.sources.shared_folder import materialize, release, settled


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per ``u`` the smallest of its ``v`` and itself, and whether it is ``done``: it has larger
    ``v`` only, or just one. Written, so that the join back can be split by adaptive execution
    where a ``u`` has many rows."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    done = (F.col("m") > F.col("u")) | (F.col("n") == 1)
    return materialize(
        smallest.select("u", F.least("u", "m").alias("m"), done.alias("done")), "component-stars"
    )


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u")).toDF("u", "v")


def _large_star(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    joined = _both(edges).join(smallest.select("u", "m"), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(down: DataFrame) -> DataFrame:
    smallest = _smallest(down).select("u", "m")
    joined = down.join(smallest, "u").where("v <> m")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for nodes that are not that.

    ``edges`` has two columns of one ordered type; equal and null ends are ignored. The number
    of rounds grows with the logarithm of the longest path. They end as soon as every node has
    either larger neighbours only or a single one: then all edges lead to the smallest nodes.
    """
    first, second = (F.col(f"`{c}`") for c in edges.columns)
    apart = edges.where(first != second)
    down = apart.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
    now = materialize(down.distinct(), "component-edges")
    while True:
        smallest = _smallest(_both(now))
        if smallest.agg(F.bool_and("done")).first()[0] is not False:
            release(smallest)
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        # every edge gives one, larger end first
        large = materialize(_large_star(now, smallest), "component-large")
        release(smallest)
        release(now)
        now = settled(lambda: _small_star(large).distinct(), "component-edges")
        release(large)
