"""Places in an order, found by counting ranges of numbers instead of moving the rows.

A range of values is divided into ``RANGES`` equal parts, the rows in each part are counted where
they are, and the part that holds the wanted place is the next range. Every round reads narrow
columns and shuffles at most ``RANGES`` counts per group and task.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayposts.sources.tables import literal_frame

RANGES = 1024


def descending(number: Column) -> Column:
    """Whole numbers in the opposite order; unlike the negative, it exists for all of them."""
    return F.bitwise_not(number)


def moment_number(column: str) -> Column:
    """A moment without zone as a whole number in the same order."""
    moment = F.col(column)
    seconds = F.hour(moment).cast("long") * 3600 + F.minute(moment) * 60
    second = F.extract(F.lit("SECOND"), moment)
    micros = seconds * 1_000_000 + (second * 1_000_000).cast("long")
    return F.unix_date(moment.cast("date")) * F.lit(86_400_000_000) + micros


def _part(value: Column, low: Column, width: Column, widest: int) -> Column:
    """The number of the part that holds ``value``, in a range of the given width."""
    columns = (value, low, width)
    if widest >= 2**63:
        columns = tuple(c.cast("decimal(20,0)") for c in columns)
    value, low, width = columns
    return F.call_function("div", value - low, width).cast("int")


def _next_range(low: int, high: int, part: int) -> tuple[int, int]:
    width = (high - low) // RANGES + 1
    return low + part * width, min(high, low + (part + 1) * width - 1)


def nth_lowest(df: DataFrame, column: str, n: int) -> int | None:
    """The ``n``-th lowest value of a column of whole numbers without nulls; None if there are
    fewer. Runs jobs; the range filters the scans, which skip the row groups outside it."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low is not None:
        part = _part(F.col(column), F.lit(low), F.lit((high - low) // RANGES + 1), high - low)
        counts = (
            df.where(F.col(column).between(low, high))
            .groupBy(part.alias("part"))
            .count()
            .orderBy("part")
            .collect()
        )
        for place, inside in counts:
            if n <= inside:
                break
            n -= inside
        else:
            return None
        low, high = _next_range(low, high, place)
        if low == high:
            return low
    return None


# Per group: the limit of each number in turn. The last limit is where the group ends; rows that
# equal all limits before it are compared by it.
Limits = dict[int, list[int]]


def _narrowed(
    rows: DataFrame, group: str, number: str, ranges: dict[int, tuple[int, int, int]], spare: int
) -> dict[int, tuple[int, int | None]]:
    """Per group, a value up to which there are the wanted rows and at most ``spare`` more, and
    None; or a value whose equals hold the wanted place, and the place among them.

    ``ranges`` give the lowest and highest value and the place, at most that of the last row.
    """
    spark = rows.sparkSession
    found: dict[int, tuple[int, int | None]] = {}
    while ranges:
        listed = [
            (g, low, high, (high - low) // RANGES + 1, n) for g, (low, high, n) in ranges.items()
        ]
        frame = literal_frame(
            spark, listed, f"{group} long, low long, high long, width long, place long"
        )
        widest = max(high - low for _, low, high, *_ in listed)
        part = _part(F.col(number), F.col("low"), F.col("width"), widest).alias("part")
        counts = (
            rows.select(group, number)
            .join(F.broadcast(frame), group)
            .where(F.col(number).between(F.col("low"), F.col("high")))
            .groupBy(group, "place", part)
            .agg(F.count(F.lit(1)).alias("inside"))
        )
        before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        until = F.col("before") + F.col("inside")
        # one row per group
        holding = (
            counts.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
            .where((F.col("before") < F.col("place")) & (F.col("place") <= until))
            .select(group, "part", "before", "inside")
            .collect()
        )
        following = {}
        for g, place, earlier, inside in holding:
            low, high = _next_range(*ranges[g][:2], place)
            wanted = ranges[g][2] - earlier
            if inside <= spare:
                found[g] = (high, None)
            elif low == high:
                found[g] = (high, wanted)
            else:
                following[g] = (low, high, wanted)
        ranges = following
    return found


def _bounds(rows: DataFrame, group: str, numbers: Sequence[str]) -> dict[int, list[int]]:
    """Per group, the lowest and the highest of each number."""
    found = [extreme(number) for number in numbers for extreme in (F.min, F.max)]
    return {g: values for g, *values in rows.groupBy(group).agg(*found).collect()}


def limits(
    rows: DataFrame, group: str, numbers: Sequence[str], groups: Sequence[int], n: int
) -> Limits:
    """Per group, the limits that its first ``n`` rows keep, and at most ``n`` others, unless more
    are equal in all ``numbers``. Each of the ``groups`` has ``n`` rows or more.

    The order is that of the columns ``numbers``, whole numbers without nulls. Runs jobs. The
    number of ``groups`` must be small: their ranges pass through the driver.
    """
    made: Limits = {g: [] for g in groups}
    places = {g: n for g in groups}
    bounds = _bounds(rows.where(F.col(group).isin(list(groups))), group, numbers)
    for level, number in enumerate(numbers):
        ranges = {}
        for g, place in places.items():
            low, high = bounds[g][2 * level : 2 * level + 2]
            if low == high:
                made[g].append(low)
            else:
                ranges[g] = (low, high, place)
        if not ranges:
            continue
        inside = rows
        if level:
            agreeing = {g: made[g] for g in ranges}
            inside = within(rows, group, numbers[:level], agreeing, equal=True)
        for g, (value, place) in _narrowed(inside, group, number, ranges, n).items():
            made[g].append(value)
            if place is None:
                del places[g]
            else:
                places[g] = place
    return made


def within(
    rows: DataFrame, group: str, numbers: Sequence[str], given: Limits, equal: bool = False
) -> DataFrame:
    """The rows of the groups in ``given`` up to their limits, or ``equal`` to them."""
    names = [f"_limit{level}" for level in range(len(numbers))]
    listed = [
        (g, *values, *[None] * (len(names) - len(values))) for g, values in given.items()
    ]
    schema = ", ".join([f"{group} long", *[f"{name} long" for name in names]])
    frame = F.broadcast(literal_frame(rows.sparkSession, listed, schema))
    steps = list(zip(numbers, names))
    if equal:
        kept = reduce(Column.__and__, [F.col(number) == F.col(name) for number, name in steps])
    else:
        kept = F.lit(True)
        for number, name in reversed(steps):
            value, limit = F.col(number), F.col(name)
            kept = limit.isNull() | (value < limit) | ((value == limit) & kept)
    return rows.join(frame, group).where(kept).drop(*names)
