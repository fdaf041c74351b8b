from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayposts.functions.binding import bind_once

# A backslash that is not itself escaped, with any escaped ones before it in group 1.
_ESCAPE = r"(?<!\\)((?:\\\\)*)\\"


# Parts of a list as Python writes it: a quoted text, and anything bare.
_QUOTED = r"""(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")"""
_BARE = r"""[^\s'",\[\]]++"""
_LIST = rf"(?s)\s*+\[\s*+(?:(?:{_QUOTED}|{_BARE})\s*+(?:,\s*+|(?=\])))*+\]\s*+"
_LAST_COMMA = r",\s*\]\s*$"
# Any of the spellings that JSON does not have.
_RARE = rf"None|nan|\\[Ux]|{_LAST_COMMA}"
# A bare word for a missing element, after any number of quoted texts and other characters.
_MISSING = rf"""(?s)\G((?:{_QUOTED}|(?!\b(?:None|nan)\b)[^'"])*+)\b(?:None|nan)\b"""


def _missing_as_json(text: Column) -> Column:
    """Bare ``None`` and ``nan`` as ``null``, which is how JSON spells them."""
    return F.regexp_replace(text, _MISSING, "$1null")


def _byte_escapes_as_json(text: Column) -> Column:
    r"""``\xe9`` as ``é``, which is how JSON spells it."""
    return F.regexp_replace(text, _ESCAPE + r"x([0-9a-fA-F]{2})", r"$1\\u00$2")


def _long_escapes_read(text: Column) -> Column:
    r"""``\U0001f600``, for which JSON has no spelling, as the character itself."""
    codes = F.regexp_extract_all(text, F.lit(_ESCAPE + r"U([0-9a-fA-F]{8})"), F.lit(2))
    return F.aggregate(
        F.array_distinct(codes),
        text,
        lambda read, code: F.regexp_replace(
            read,
            F.concat(F.lit(_ESCAPE + "U"), code),
            F.concat(F.lit("$1"), F.decode(F.unhex(code), "UTF-32")),
        ),
    )


def _lists_only(text: Column) -> Column:
    return F.when(text.rlike(f"^{_LIST}$"), text)


def _rare_spellings_as_json(text: Column) -> Column:
    """What Python writes and JSON does not have; most texts hold none of it."""

    def where(test: Callable[[Column], Column], change: Callable[[Column], Column]) -> Callable:
        return lambda t: F.when(test(t), change(t)).otherwise(t)

    read = bind_once(
        text,
        where(lambda t: t.rlike("None|nan"), _missing_as_json),
        where(lambda t: t.rlike(_LAST_COMMA), lambda t: F.regexp_replace(t, _LAST_COMMA, "]")),
        where(lambda t: t.contains("\\U"), _long_escapes_read),
        where(lambda t: t.contains("\\x"), _byte_escapes_as_json),
    )
    return F.when(text.rlike(_RARE), read).otherwise(text)


def parse_tags(text) -> Column:
    """A list written as text, ``['a', "it's"]``, as ``array<string>``; bad text gives null.

    Bare ``None`` and ``nan`` are null elements, and a comma may follow the last element. The
    expression refers to the text once, so that a computed text is computed once.
    """
    return F.from_json(
        bind_once(F.col(text), _lists_only, _rare_spellings_as_json),
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
