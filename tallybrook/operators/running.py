"""Per-key running results over an ordered table, and their final forms (batch).

``order`` must be unique within a key. Options of :func:`tallybrook.operators.scan.prefix_scan`
(``rows_per_chunk``, ``max_chunks``, ``n_rows``) are passed through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.times import epoch_micros
from tallybrook.operators.scan import prefix_scan


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, out="n", **scan) -> DataFrame:
    """The change log of a per-key count: a key seen k times gets 1..k."""
    return prefix_scan(df, keys, order, {out: ("count", F.lit(1))}, **scan)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, *, out="total", **scan
) -> DataFrame:
    return prefix_scan(df, keys, order, {out: ("sum", F.col(amount))}, **scan)


def running_avg(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, *, out="average", **scan
) -> DataFrame:
    """Average of the amounts so far, as a double; null amounts do not count."""
    scanned = prefix_scan(
        df, keys, order, {"_sum": ("sum", F.col(amount)), "_n": ("count", F.col(amount))}, **scan
    )
    return scanned.select(
        *df.columns, F.try_divide(F.col("_sum").cast("double"), F.col("_n")).alias(out)
    )


def flag_small_then_large(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    *,
    small: float,
    large: float,
    ts: str | None = None,
    max_gap_seconds: float | None = None,
    out: str = "flagged",
    **scan,
) -> DataFrame:
    """Flag a row above ``large`` whose direct predecessor in its key was below ``small``.

    With ``ts`` and ``max_gap_seconds`` the two must lie no further apart than that.
    """
    carried = {"_prev": ("last", F.col(amount))}
    if max_gap_seconds is not None:
        carried["_prev_us"] = ("last", epoch_micros(df, ts))
    scanned = prefix_scan(df, keys, order, carried, include_current=False, **scan)
    rule = (F.col(amount) > large) & (F.col("_prev") < small)
    if max_gap_seconds is not None:
        rule &= epoch_micros(df, ts) - F.col("_prev_us") <= int(max_gap_seconds * 1_000_000)
    return scanned.select(*df.columns, F.coalesce(rule, F.lit(False)).alias(out))


def top_k(
    df: DataFrame, keys: Sequence[str], best_first: Sequence[Column], k: int, *, out="rank"
) -> DataFrame:
    """The ``k`` first rows of each key. Every task keeps only its own ``k`` before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*best_first)
    return df.withColumn(out, F.row_number().over(ranked)).where(F.col(out) <= k)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, *, out="n") -> DataFrame:
    """How often each value occurs in each key (batch, or a stream in update mode)."""
    return df.groupBy(*keys, value).agg(F.count("*").alias(out))


def latest_total(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Count, sum and average per key (batch, or a stream in update mode: one row per key and batch).

    For streams with hot keys: amounts are combined before the shuffle, at the price of one change
    per batch in place of one per row.
    """
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), F.avg(amount).alias("average")
    )
