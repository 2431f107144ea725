"""Script-independent text functions, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 white-space characters of Unicode-aware strip and split.
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
SPACES = r"[\s\x0b\x1c-\x1f\x85\xa0  -     　]+"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACE_CHARS))


def tokens(x: Column) -> Column:
    """The white-space separated tokens; null for null."""
    return F.filter(F.split(x, SPACES), lambda t: t != "")


def sentences(x: Column, delimiters: str) -> Column:
    """The stripped, non-empty pieces between runs of delimiters."""
    return F.filter(F.transform(F.split(x, delimiters), strip), lambda s: s != "")


def attribute(line: Column, key: str) -> Column:
    """The last `key=value` among a line's comma-separated fields after the first; null if there is none."""
    fields = F.filter(F.slice(F.split(line, ","), 2, 1 << 20), lambda p: p.startswith(f"{key}="))
    return F.substring(F.try_element_at(fields, F.lit(-1)), len(key) + 2, 1 << 20)


def whole_number(x: Column, default: int | None = None) -> Column:
    """A signed decimal integer, else the default."""
    found = F.when(strip(x).rlike("^[+-]?[0-9]+$"), strip(x).try_cast("int"))
    return found if default is None else F.coalesce(found, F.lit(default))


def clamp(f: Column) -> Column:
    return F.least(F.greatest(f, F.lit(1)), F.lit(255))


def adjacent_pairs(words: Column) -> Column:
    """[(w1, w2), ...] of neighbouring elements."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))
    return F.when(n >= 2, pairs)
