"""Text repair, strict parsing and formatting, as ``Column -> Column`` functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from regain.config import TEXT_REPAIRS

# Every Unicode space separator: the source trims all of them, Spark's default only U+0020.
SPACES = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def blank_to_null(col: Column) -> Column:
    """Trimmed, blank as NULL. Trimming by a set of characters looks at each one: text of ASCII only needs U+0020 trimmed."""
    plain = F.trim(col)
    is_ascii = F.octet_length(plain) == F.char_length(plain)
    return F.nullif(F.when(is_ascii, plain).otherwise(F.trim(plain, F.lit(SPACES))), F.lit(""))


def clean_text(name: str | Column) -> Column:
    """Repair double-encoded characters, trim, and turn blank text into NULL."""
    col = F.col(name) if isinstance(name, str) else name
    for garbled, intended in TEXT_REPAIRS:
        col = F.replace(col, F.lit(garbled), F.lit(intended))
    return blank_to_null(col)


def to_date_strict(name: str) -> Column:
    """``MM/DD/YYYY`` text to a date; a bad value fails the job (ANSI mode)."""
    return F.to_date(blank_to_null(F.col(name)), "M/d/yyyy")


def to_amount(name: str) -> Column:
    return F.col(name).cast("decimal(18,4)")


def to_int(name: str) -> Column:
    return F.col(name).cast("int")


def is_present(name: str, trim: bool = False) -> Column:
    """Marker columns: anything but an empty field counts, spaces included unless they are trimmed."""
    return (blank_to_null(F.col(name)) if trim else F.col(name)).isNotNull()


def matches(col: Column, pattern: str) -> Column:
    """Regex search with ASCII word boundaries.

    Java's ``\\b`` follows Unicode letters; the rules are written for ASCII word characters. A boundary
    before a word or group becomes "no word character before", any other "no word character after".
    """
    pattern = re.sub(r"\\b(?=[\w(])", r"(?<!\\w)", pattern)
    return col.rlike(pattern.replace(r"\b", r"(?!\w)"))


def upper_or_blank(name: str) -> Column:
    return F.upper(F.coalesce(F.col(name), F.lit("")))


def fmt_money(col: Column) -> Column:
    """Whole dollars with thousands separators: 1234.5 -> $1,235 and -250 -> -$250."""
    sign = F.when(col < 0, F.lit("-$")).otherwise(F.lit("$"))
    return F.concat(sign, F.format_number(F.abs(F.round(col)), 0))


def sorted_text(col: Column, separator: str = ", ") -> Column:
    """Distinct values in order, joined; NULL when there are none. For columns of few values."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(col)), separator), F.lit(""))
