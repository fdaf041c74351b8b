"""Column expressions over texts that several operators share."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACES_PATTERN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: Column) -> Column:
    """The text; an empty one for null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: maximal runs of characters other than space and ``\\t`` to ``\\r``."""
    return F.array_remove(F.split(whole(text), SPACES_PATTERN), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) > 0


def crc_fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document, by the CRC-32 of its id as text; null counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
