"""Texts and colours of the chart and map tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayposts.schema import CENTER_TEXT, PALETTE, POST_TEXT


def alphanumeric(text) -> Column:
    """``text`` without anything but letters and digits of any script."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def timestamp_text(moment) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, followed by six digits of a second where they are not all 0."""
    # The cast drops the zeros at the end of a fraction. Unlike date_format it does not pass
    # through the session's time zone, where some local times do not exist.
    text = F.col(moment).cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def _or_null_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("null"))


def post_text(owner, taken, views) -> Column:
    """The info text of a post marker."""
    return F.format_string(
        POST_TEXT,
        alphanumeric(owner),
        _or_null_text(timestamp_text(taken)),
        _or_null_text(F.col(views).cast("string")),
    )


def center_text(cluster, size) -> Column:
    """The info text of a cluster centre marker."""
    return F.format_string(CENTER_TEXT, F.col(cluster), F.col(size))


def prefixed(prefix: str, number) -> Column:
    """``U1`` for prefix ``U`` and number 1."""
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


def palette_color(index) -> Column:
    """The colour of the 0-based ``index``; the palette starts again when it is used up."""
    colors = F.array(*[F.lit(color) for color in PALETTE])
    return F.element_at(colors, (F.col(index) % len(PALETTE) + 1).cast("int"))
