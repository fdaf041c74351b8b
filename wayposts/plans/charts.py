"""The data of the bar charts, one row per bar: ``chart, label, value``."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.functions import prefixed
from wayposts.schema import OWNER_LABEL


def _bars(report: DataFrame, label, *measures: str) -> DataFrame:
    values = [F.col(measure).cast("double").alias(measure) for measure in measures]
    wide = report.select(label.alias("label"), *values)
    long = wide.unpivot("label", list(measures), "chart", "value")
    return long.select("chart", "label", "value")


def tag_chart_data(top_tags: DataFrame) -> DataFrame:
    """Occurrences and mean views of the tags of a ``top_tags`` result."""
    return _bars(top_tags, F.col("tag"), "count", "mean_views")


def owner_chart_data(active_users: DataFrame) -> DataFrame:
    """Posts and mean views of the owners of an ``active_users`` result, as U1, U2, ..."""
    return _bars(active_users, prefixed(OWNER_LABEL, "id"), "num_post", "mean_views")
