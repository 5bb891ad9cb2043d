"""Windows that merge: sessions of rows that follow each other within a gap (batch; the streaming twin is in ``streaming``).

A row is a session of its own from its time to its time plus the gap; sessions of a key that overlap or touch merge, and so do their
accumulators. Rows of equal time are combined in the tasks first. The merging is two running maxima per
key, which split a hot key over tasks (see ``scan``): how far the sessions before reach, and where the last one began.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import seconds_interval
from tallybrook.operators.scan import prefix_scan

MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def merge_sessions(sessions: DataFrame, keys: Sequence[str], values: dict[str, str], **scan) -> DataFrame:
    """Sessions that overlap or touch, made one: ``*keys, session_start, session_end, *values``.

    ``values`` says how each accumulator merges: ``count``, ``sum``, ``min`` or ``max``. The result of a part of the
    sessions can be merged with others later, in any order.
    """
    merged = [MERGES[how](name).alias(name) for name, how in values.items()]
    once = sessions.groupBy(*keys, "session_start").agg(F.max("session_end").alias("session_end"), *merged)
    reach = prefix_scan(once, keys, ["session_start"], {"_reach": ("max", F.col("session_end"))}, include_current=False, **scan)
    opens = F.col("_reach").isNull() | (F.col("session_start") > F.col("_reach"))
    opened = reach.withColumn("_opened", F.when(opens, F.col("session_start")))
    placed = prefix_scan(opened, keys, ["session_start"], {"_first": ("max", F.col("_opened"))}, **scan)
    return (
        placed.groupBy(*keys, "_first")
        .agg(F.max("session_end").alias("session_end"), *merged)
        .select(*keys, F.col("_first").alias("session_start"), "session_end", *values)
    )


def row_sessions(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Each row as a session. ``values`` maps an accumulator to ``(how, column)``; rows without a time have none."""
    start = {name: F.lit(1).cast("bigint") if how == "count" else column for name, (how, column) in values.items()}
    return df.where(F.col(ts).isNotNull()).select(
        *keys,
        F.col(ts).alias("session_start"),
        (F.col(ts) + seconds_interval(gap_seconds)).alias("session_end"),
        *[column.alias(name) for name, column in start.items()],
    )


def sessions(
    df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], values: dict[str, tuple[str, Column]], **scan
) -> DataFrame:
    """``*keys, session_start, session_end, *values`` of a table; a session ends a gap after its last row."""
    scan.setdefault("n_rows", df.count())  # no more sessions than rows
    how = {name: kind for name, (kind, _) in values.items()}
    return merge_sessions(row_sessions(df, ts, gap_seconds, keys, values), keys, how, **scan)
