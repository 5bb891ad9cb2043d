"""Exact split of on-time and late rows (batch; the streaming twin is in ``streaming``).

Rows arrive in ``order`` (columns that are unique together). With M the largest event time among the rows before a row (of
the table, or of the row's key), D the allowed disorder and L the allowed lateness, the row is late
when ``M >= end of its window + D + L``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import epoch_millis, seconds_interval
from tallybrook.operators.scan import prefix_scan
from tallybrook.operators.windows import window_agg, with_window

# One sequence over the whole table is cut sooner than a per-key one: nothing else splits it.
GLOBAL_ROWS_PER_CHUNK = 1 << 13


def prior_max(df: DataFrame, ts: str, order: Sequence[str], keys: Sequence[str] = (), **scan) -> DataFrame:
    """Add ``prior_max_ts``, the largest time before each row; null for a first row."""
    if not keys:
        scan = {"rows_per_chunk": GLOBAL_ROWS_PER_CHUNK, **scan}
    return prefix_scan(
        df, keys, order, {"prior_max_ts": ("max", F.col(ts))}, include_current=False, **scan
    )


def split_late(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    seconds: int,
    *,
    delay_seconds: int = 0,
    lateness_seconds: int = 0,
    keys: Sequence[str] = (),
    **scan,
) -> DataFrame:
    """Add ``prior_max_ts, window_start, window_end, is_late``. No row with a time is dropped."""
    marked = with_window(prior_max(df, ts, order, keys, **scan), ts, seconds)
    closed = F.col("window_end") + seconds_interval(delay_seconds + lateness_seconds)
    return marked.withColumn(
        "is_late", F.coalesce(F.col("prior_max_ts") >= closed, F.lit(False))
    )


def on_time(split: DataFrame) -> DataFrame:
    return split.where(~F.col("is_late"))


def late(split: DataFrame) -> DataFrame:
    """The late table: the row, its window and the time that had closed it."""
    return split.where(F.col("is_late"))


def on_time_windows(
    split: DataFrame, ts: str, seconds: int, keys: Sequence[str], aggs: dict[str, Column]
) -> DataFrame:
    """Window aggregates over the on-time rows: the last revision of each window."""
    return window_agg(on_time(split), ts, seconds, keys, aggs)


def watermark_trace(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    *,
    delay_seconds: int = 0,
    keys: Sequence[str] = (),
    **scan,
) -> DataFrame:
    """Per row the watermark it met, in epoch milliseconds; null for a first row."""
    names = list(dict.fromkeys([*keys, *order]))
    marked = prior_max(df.select(*dict.fromkeys([*names, ts])), ts, order, keys, **scan)
    met = epoch_millis(marked, "prior_max_ts") - (delay_seconds * 1000 + 1)
    return marked.select(*names, met.alias("watermark_ms"))
