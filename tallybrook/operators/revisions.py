"""Every result that windows of one arrival sequence give: one when a window closes, one for each row accepted later (batch).

Rows, windows and terms are those of ``late``. A window closes at the row whose time takes the largest time so far over its
end plus the allowed disorder. Rows that raise the largest time are in the order of their times and of their arrival at once, so
the closing row is the next of them in time: a lookup along one sequence, which ``scan`` cuts over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import epoch_micros, seconds_interval
from tallybrook.operators.late import GLOBAL_ROWS_PER_CHUNK, split_late
from tallybrook.operators.scan import prefix_scan


def window_revisions(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    seconds: int,
    value: Column,
    *,
    delay_seconds: int = 0,
    lateness_seconds: int = 0,
    **scan,
) -> DataFrame:
    """``window_start, window_end, revision, n, total, *order``: the row of ``order`` is the one that made the revision.

    Revisions of a window count from 0. The first has its rows from before it closed; if there were none, its first
    accepted row. Each row that comes after that, and is not late, makes one more, with all rows so far. ``n`` counts
    rows and ``total`` adds up ``value``, null without any. Windows that never close give nothing. ``order`` is unique and ``ts`` of no row is null.
    """
    needed = df.select(*dict.fromkeys([*order, ts]), value.alias("_v"))
    marked = split_late(
        needed, ts, order, seconds, delay_seconds=delay_seconds, lateness_seconds=lateness_seconds, **scan
    ).withColumn("_closing", F.col("window_end") + seconds_interval(delay_seconds))
    after = F.coalesce(F.col("prior_max_ts") >= F.col("_closing"), F.lit(False))
    window = ["window_start", "window_end"]
    before = marked.where(~after).groupBy(*window, "_closing").agg(F.count("*").alias("_n0"), F.sum("_v").alias("_t0"))

    # From the latest time to the earliest: the last raising row before a closing time is the next one in time.
    place = F.struct(*order)
    raising = marked.where(F.col("prior_max_ts").isNull() | (F.col(ts) > F.col("prior_max_ts"))).select(
        (-epoch_micros(marked, ts)).alias("_when"), F.lit(0).alias("_kind"), place.alias("_by")
    )
    closings = before.select((-epoch_micros(before, "_closing")).alias("_when"), F.lit(1).alias("_kind"), *window, "_n0", "_t0")
    both = closings.unionByName(raising, allowMissingColumns=True)
    # The place of a raising row goes down along the sequence, so the last is the least.
    limits = {"rows_per_chunk": GLOBAL_ROWS_PER_CHUNK, **scan}
    closed = prefix_scan(both, [], ["_when", "_kind"], {"_closed_by": ("min", F.col("_by"))}, **limits).where("_kind = 1")
    first = closed.where(F.col("_closed_by").isNotNull()).select(
        *window, F.lit(0).cast("bigint").alias("revision"), F.col("_n0").alias("n"), F.col("_t0").alias("total"), "_closed_by.*"
    )

    accepted = marked.where(after & ~F.col("is_late")).select(*window, *order, "_v")
    later = prefix_scan(accepted, window, order, {"_rn": ("count", F.lit(1)), "_sum": ("sum", F.col("_v"))}, **scan)
    known = before.select(*window, "_n0", "_t0")
    joined = later.join(known, window, "left")
    more = joined.select(
        *window,
        (F.col("_rn") - F.when(F.col("_n0").isNull(), 1).otherwise(0)).cast("bigint").alias("revision"),
        (F.coalesce("_n0", F.lit(0)) + F.col("_rn")).alias("n"),
        F.coalesce(F.col("_t0") + F.col("_sum"), "_t0", "_sum").alias("total"),
        *order,
    )
    return first.unionByName(more)
