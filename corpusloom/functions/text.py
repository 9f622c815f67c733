"""Byte-level text expressions.

The index works on UTF-8 bytes, not characters: lower-casing touches A-Z only
and a gram may hold part of a character. Everything here is a built-in column
expression, so it stays in generated code on the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the search format.
GRAM_BYTES = 3
PREVIEW_BYTES = 120


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z; every other character, accented ones too, is kept."""
    return F.translate(_col(c), string.ascii_uppercase, string.ascii_lowercase)


def normalized_bytes(c: Column | str) -> Column:
    """UTF-8 bytes of the ASCII-lowered text."""
    return F.encode(ascii_lower(c), "UTF-8")


def has_grams(c: Column | str) -> Column:
    """True when a text is long enough to hold one gram.

    ASCII lower-casing keeps the byte length, so the raw text is measured.
    """
    return F.octet_length(_col(c)) >= GRAM_BYTES


def trim_spaces(c: Column | str) -> Column:
    """Strip 0x20 from both ends; tabs and line ends stay."""
    return F.trim(_col(c))


def query_grams(c: Column | str, windows: int | None = None) -> Column:
    """Distinct grams of a query, as array<binary>; of its first `windows` windows if given.

    Queries under three bytes give an empty array.
    """
    text = trim_spaces(c)
    data = normalized_bytes(text)
    last = F.octet_length(text) - (GRAM_BYTES - 1)
    last = last if windows is None else F.least(last, F.lit(windows))
    # An outer array of one: a column inside a lambda would be made anew for every window.
    # Distinct as hex texts: of binaries, Spark compares every pair.
    windows_of = F.transform(
        F.array(data),
        lambda d: F.transform(F.sequence(F.lit(1), last), lambda i: F.hex(F.substring(d, i, F.lit(GRAM_BYTES)))),
    )
    grams = F.transform(F.array_distinct(F.flatten(windows_of)), F.unhex)
    return F.when(has_grams(text), grams).otherwise(
        F.array().cast("array<binary>")
    )


def preview_bytes(c: Column | str, size: int = PREVIEW_BYTES) -> Column:
    """First `size` bytes of a text; may end inside a character.

    `size` characters always cover `size` bytes, so only those are encoded.
    """
    return F.substring(F.encode(F.substring(_col(c), 1, size), "UTF-8"), 1, size)


def preview(c: Column | str, size: int = PREVIEW_BYTES) -> Column:
    """`preview_bytes` as text, without a character cut off at the end.

    A UTF-8 character has at most four bytes, so dropping up to three bytes
    always reaches a whole character; text that was not UTF-8 to begin with is
    repaired instead.
    """
    data = preview_bytes(shown_text(c), size)
    cuts = [
        F.try_validate_utf8(F.substring(data, 1, n).cast("string"))
        for n in range(size, size - 4, -1)
    ]
    return F.coalesce(*cuts, F.make_valid_utf8(F.substring(data, 1, size).cast("string")))


def shown_title(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("(null)"))


def shown_text(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def duration(seconds: Column | str) -> Column:
    """Seconds as `HHh MMm SSs`, fractions dropped."""
    whole = _col(seconds).cast("bigint")
    return F.format_string(
        "%02dh %02dm %02ds",
        F.floor(whole / 3600),
        F.floor(whole % 3600 / 60),
        whole % 60,
    )
