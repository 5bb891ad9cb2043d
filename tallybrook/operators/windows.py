"""Tumbling windows: ``[start, end)`` of a fixed width, aligned to the epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import as_instant, epoch_millis


def with_window(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Add ``window_start`` and ``window_end``. Rows without a time belong to no window."""
    return (
        df.withColumn("_w", F.window(ts, f"{seconds} seconds"))
        .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        .drop("_w")
    )


def window_agg(
    df: DataFrame,
    ts: str,
    seconds: int,
    keys: Sequence[str],
    aggs: dict[str, Column],
    *,
    delay_seconds: int | None | str = "unset",
) -> DataFrame:
    """``window_start, window_end, *keys, *aggs``; ``keys=[]`` gives one group per window.

    Batch or stream. Built-in aggregates are kept incrementally and combined before the shuffle, so
    one hot key or window costs one small row per task. A stream gets a watermark on ``ts`` with
    ``delay_seconds``: in append mode a window comes out when a later batch passes its end, and rows
    behind the watermark are only counted in the query's metrics (``late`` keeps them instead). With
    ``delay_seconds=None`` windows never close: for update or complete mode. A stream has to say which.
    """
    if df.isStreaming:
        if delay_seconds == "unset":
            raise ValueError("a stream needs delay_seconds: how late its rows may be, or None for windows that stay open")
        df = as_instant(df, ts)
        if delay_seconds is not None:
            df = df.withWatermark(ts, f"{delay_seconds} seconds")
    return (
        df.groupBy(F.window(ts, f"{seconds} seconds").alias("_w"), *keys)
        .agg(*[column.alias(name) for name, column in aggs.items()])
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *keys,
            *aggs,
        )
    )


def window_count(df: DataFrame, ts: str, seconds: int, keys: Sequence[str], *, out="cnt", **kw):
    return window_agg(df, ts, seconds, keys, {out: F.count("*")}, **kw)


def window_sum(df: DataFrame, ts: str, seconds: int, keys: Sequence[str], value: str, *, out="total", **kw):
    """Sums of integers are 64-bit and do not wrap at 2**31."""
    return window_agg(df, ts, seconds, keys, {out: F.sum(value)}, **kw)


def window_max(df: DataFrame, ts: str, seconds: int, keys: Sequence[str], value: str, *, out="max", **kw):
    """NaN counts as the largest double."""
    return window_agg(df, ts, seconds, keys, {out: F.max(value)}, **kw)


def window_line(df: DataFrame, key: str, key_label: str, value: str, value_label: str) -> DataFrame:
    """Add ``line``: ``<key_label>=<key> window=[<start ms>,<end ms>) <value_label>=<value>``."""
    return df.withColumn(
        "line",
        F.format_string(
            f"{key_label}=%s window=[%d,%d) {value_label}=%d",
            F.col(key).cast("string"),
            epoch_millis(df, "window_start"),
            epoch_millis(df, "window_end"),
            F.col(value),
        ),
    )


def input_line(df: DataFrame, value: str) -> DataFrame:
    """Add ``line``: the echo of an input value."""
    return df.withColumn("line", F.concat(F.lit("Input Data> "), F.col(value).cast("string")))


def firing_line(df: DataFrame, total: str = "total", n: str = "n") -> DataFrame:
    """Add ``line``: one firing of a counted window."""
    return df.withColumn(
        "line", F.format_string("Sum of window> %d (count=%d)", F.col(total), F.col(n))
    )
