"""Column functions: built from Spark's own expressions, no Python on the executors."""

from wayposts.functions.binding import bind_once, computed_once
from wayposts.functions.labels import (
    alphanumeric,
    center_text,
    palette_color,
    post_text,
    prefixed,
    timestamp_text,
)
from wayposts.functions.tag_text import parse_tags

__all__ = [
    "alphanumeric",
    "bind_once",
    "center_text",
    "computed_once",
    "palette_color",
    "parse_tags",
    "post_text",
    "prefixed",
    "timestamp_text",
]
