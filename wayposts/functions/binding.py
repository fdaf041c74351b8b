from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind_once(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """``value`` through ``steps``, each computed once however often the next one refers to it.

    Written out, a step that names its input three times makes three copies of all the steps
    before it. Bound, the input is a variable.
    """
    return reduce(lambda bound, step: F.get(F.transform(F.array(bound), step), F.lit(0)), steps, value)


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df.select(*columns)``, where filters on the result do not compute the columns again.

    Spark moves a filter below a plain projection and repeats the expressions it refers to; it
    leaves it above a generator, here of one row per row.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
