"""Top-k, numbering and top-k per group, without moving whole groups to one task."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayposts.operators import selection
from wayposts.sources.shared_folder import materialize

# A sorted result of at most this many rows is merged or numbered in one task.
REPORT_ROWS = 1_000

# Fewer rows of large groups than this are sorted whole: moving them takes less time than the
# jobs that would count how few are needed. The result is the same.
WORTH_COUNTING = 1_000_000

_LONG = 2**63 - 1
# Bits of a row's place within its partition, in the ids that Spark counts up.
_PLACE_BITS = 33


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` written in ``order``: partition ``_part`` after partition, ``_at`` within it."""
    parts = shuffle_partitions(df.sparkSession)
    placed = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_at", placed)
    written = materialize(numbered, "sorted")
    return written.withColumn("_part", F.shiftright("_at", _PLACE_BITS))


def number_rows(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Number the rows of a table of any size from 1, in an ``order`` without ties.

    The rows are sorted by range; a row's number is its place in its partition and the rows in
    the partitions before. Writes the sorted rows to the shared folder.
    """
    ordered = _range_sorted(df, *order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, so safe to broadcast
    starts = (
        ordered.groupBy("_part")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    number = F.col("_at") - F.col("_first") + F.col("_start") + 1
    return ordered.join(F.broadcast(starts), "_part").select(
        *df.columns, number.cast("long").alias(name)
    )


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows in ``order``.

    For a report every task keeps its own ``n`` before the merge. More rows are sorted by
    range and numbered, so that no task sees more than its part.
    """
    if n <= REPORT_ROWS:
        return df.orderBy(*order).limit(n)
    first = number_rows(df, "_place", *order).where(F.col("_place") <= min(n, _LONG))
    return first.orderBy("_place").drop("_place")


def sorted_report(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """``df`` in ``order``, where ``df`` is known to have at most ``rows`` rows."""
    if rows <= REPORT_ROWS:
        return top_rows(df, rows, *order)
    return df.orderBy(*order)


def numbered(report: DataFrame, name: str, rows: int, *order: Column) -> DataFrame:
    """Number the rows of a report of at most ``rows`` rows from 1."""
    if rows <= REPORT_ROWS:
        return report.withColumn(name, F.row_number().over(Window.orderBy(*order)))
    return number_rows(report, name, *order)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _cut(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int, name: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).where(F.col(name) <= min(n, 2**31 - 1))


def _group_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    name: str | None = None,
    numbers: Sequence[Column] = (),
) -> DataFrame:
    """The first ``n`` rows of each group, with their place in column ``name`` if given.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark cuts every group to ``n``
    rows before the shuffle, so a group of any size is safe. For more rows, groups that hold
    more than a partition's share are sorted by range and numbered across the partitions; the
    others are numbered in one task each. Where ``numbers`` give the ``order`` as whole numbers
    without nulls, counts of their ranges find about where each large group's place ``n`` is,
    and only the rows up to it are moved.
    """
    spark = df.sparkSession
    place = name or "_place"
    if n <= _group_limit(spark):
        top = _cut(df, keys, order, n, place)
    else:
        top = _top_of_large_groups(materialize(df, "grouped"), keys, order, n, place, numbers)
    return top if name else top.drop(place)


def _top_of_large_groups(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    place: str,
    numbers: Sequence[Column],
) -> DataFrame:
    spark = rows.sparkSession
    sizes = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_size")
    )
    share = max(rows.count() // shuffle_partitions(spark), 1)
    # at most as many groups as there are partitions, so safe to broadcast
    large = sizes.where(F.col("_size") > share).withColumn("_group", F.monotonically_increasing_id())
    large = F.broadcast(materialize(large, "large-groups"))
    small = _cut(rows.join(large, _same(rows, large, keys), "left_anti"), keys, order, n, place)
    theirs = _up_to_place(rows, large, keys, numbers, n)
    ordered = _range_sorted(theirs, *[F.col(k) for k in keys], *order)
    before = Window.partitionBy(*[f"_{k}" for k in keys]).orderBy("__part")
    # a large group touches more than one partition or fills one: at most twice their number
    starts = (
        ordered.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("__part"))
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_start",
            F.coalesce(
                F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
    )
    starts = F.broadcast(starts.drop("_n"))
    here = _same(ordered, starts, keys) & (ordered["_part"] == starts["__part"])
    number = F.col("_at") - F.col("_first") + F.col("_start") + 1
    numbered_rows = ordered.join(starts, here).withColumn(place, number)
    top = numbered_rows.where(F.col(place) <= min(n, _LONG)).select(*rows.columns, place)
    return small.unionByName(top)


def _up_to_place(
    rows: DataFrame, large: DataFrame, keys: Sequence[str], numbers: Sequence[Column], n: int
) -> DataFrame:
    """The rows of the ``large`` groups among which are the first ``n`` of each.

    Of groups with more than twice as many rows only few others are kept.
    """
    sizes = {row["_group"]: row["_size"] for row in large.select("_group", "_size").collect()}
    longer = [group for group, size in sizes.items() if size > 2 * n]
    spared = sum(sizes[group] - n for group in longer)
    if not numbers or not longer or not n or spared < WORTH_COUNTING:
        return rows.join(large, _same(rows, large, keys), "left_semi")
    columns = {f"_number{level}": number for level, number in enumerate(numbers)}
    numbered_rows = rows.withColumns(columns)
    marked = numbered_rows.join(large, _same(numbered_rows, large, keys))
    narrow = marked.select("_group", *columns)
    limits = selection.limits(narrow, "_group", list(columns), longer, n)
    limits |= {group: [] for group in sizes if group not in limits}
    return selection.within(marked, "_group", list(columns), limits).select(*rows.columns)


def with_group_size(df: DataFrame, keys: Sequence[str], name: str, most: int) -> DataFrame:
    """``df`` with the size of each row's group, where groups have at most ``most`` rows."""
    if most <= _group_limit(df.sparkSession):
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    sizes = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias(name)
    )
    return df.join(sizes, _same(df, sizes, keys)).drop(*[f"_{k}" for k in keys])
