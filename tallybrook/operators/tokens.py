"""Tokenising and word counts (batch and streaming input)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import contains_text, words


def tokenize(
    df: DataFrame,
    text: str = "value",
    *,
    out: str = "word",
    lower: bool = True,
    position: str | None = None,
) -> DataFrame:
    """One row per non-empty word of ``text``; the text itself is not carried along.

    ``position`` names an optional column with the word's index in its line. Null lines give no rows.
    """
    kept = [c for c in df.columns if c != text]
    pieces = words(F.col(text), lower)
    if position:
        exploded = df.select(*kept, F.posexplode(pieces).alias(position, out))
    else:
        exploded = df.select(*kept, F.explode(pieces).alias(out))
    return exploded.where(F.col(out) != "")


def word_count(df: DataFrame, text: str = "value", *, lower: bool = True) -> DataFrame:
    """``word, cnt`` over the whole input. Counts are combined before the shuffle."""
    return tokenize(df.select(text), text, lower=lower).groupBy("word").agg(F.count("*").alias("cnt"))


def containing(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(contains_text(F.col(column), needle))
