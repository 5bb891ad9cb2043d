"""Text columns: trimming, tokenising, substring tests. All stay in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters U+0000..U+0020 that the record parsers trim (not only spaces).
TRIMMED = "".join(map(chr, range(0x21)))


def strip_controls(text: Column) -> Column:
    """Remove leading and trailing characters up to and including U+0020."""
    return F.btrim(text, F.lit(TRIMMED))


def is_not_blank(text: Column) -> Column:
    """True for a line with something on it; null (so filtered out) for a null line."""
    return strip_controls(text) != ""


def words(text: Column, lower: bool = True) -> Column:
    """Array of the pieces between runs of non-word characters; may hold one empty piece at each end.

    Word characters are ASCII letters, digits and ``_``; an accented letter separates.
    """
    return F.split(F.lower(text) if lower else text, r"\W+")


def contains_text(text: Column, needle: str) -> Column:
    return F.contains(text, F.lit(needle))
