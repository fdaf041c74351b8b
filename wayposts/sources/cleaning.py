"""From text columns to clean, typed posts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayposts.functions import computed_once, parse_tags
from wayposts.operators.ranking import number_rows, top_per_group
from wayposts.schema import POSTS_SCHEMA, REQUIRED_COLUMNS


def _typed(field: T.StructField, source: T.DataType) -> Column:
    column = F.col(field.name)
    if source == field.dataType:
        return column
    if isinstance(field.dataType, T.ArrayType):
        return parse_tags(field.name).alias(field.name)
    if isinstance(field.dataType, T.IntegralType):
        return _whole_number(column, field.dataType).alias(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return _moment(column).alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def _whole_number(text: Column, kind: T.DataType) -> Column:
    """A whole number, however it is written: exports have 12.0 where a column has gaps."""
    plain = F.regexp_replace(text, r"\.0+$", "").try_cast(kind)
    value = text.try_cast("decimal(38,6)")
    exact = F.when(value == F.floor(value), value.try_cast(kind))
    # the later ones are computed only where those before them are null
    return F.coalesce(text.try_cast(kind), plain, exact)


# A date, or a date and time to the second or finer: the usual spelling of a moment.
_PLAIN_MOMENT = r"^\d{4}-\d\d-\d\d(?:[ T]\d\d:\d\d:\d\d(?:\.\d+)?)?$"
_ZONE = r"\d[ ]?([zZ]|UTC|GMT|[+-]\d{1,2}(:?\d{2}){0,2})\s*$"


def _moment(text: Column) -> Column:
    """A moment without zone; text that names its zone is taken to UTC."""
    zoned = ~text.rlike(_PLAIN_MOMENT) & text.rlike(_ZONE) & text.rlike(r"\d:\d")
    micros = F.unix_micros(text.try_cast("timestamp"))
    in_utc = F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.when(zoned, in_utc).otherwise(text.try_cast("timestamp_ntz"))


def _typed_columns(raw: DataFrame) -> list[Column]:
    given = {field.name: field.dataType for field in raw.schema}
    return [_typed(f, given[f.name]) for f in POSTS_SCHEMA if f.name in given]


def type_posts(raw: DataFrame) -> DataFrame:
    """Text columns cast to the types of the posts; text that does not fit becomes null."""
    return raw.select(*_typed_columns(raw))


def clean_posts(raw: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Typed posts without gaps in the ``required`` columns and without duplicates.

    Of several rows with one ``post_id`` the last updated stays, then the first by content.
    Posts that come without ids lose their exact copies and are numbered from 1 in the order
    of their content, whatever the order in which they come.
    """
    typed = computed_once(raw, *_typed_columns(raw))
    complete = typed.dropna(subset=[c for c in required if c in typed.columns])
    if "post_id" not in typed.columns:
        once = complete.distinct()
        return number_rows(once, "post_id", *map(F.col, typed.columns)).select(
            "post_id", *typed.columns
        )
    content = [F.col(c).asc() for c in typed.columns if c != "post_id"]
    order = [F.col("lastUpdate").desc_nulls_last()] if "lastUpdate" in typed.columns else []
    return top_per_group(complete, ["post_id"], [*order, *content], 1)
