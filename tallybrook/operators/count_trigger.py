"""Windows that fire on every k-th row (batch; the streaming twin is in ``streaming``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.scan import prefix_scan
from tallybrook.operators.windows import with_window


def count_trigger_sums(
    df: DataFrame,
    ts: str,
    seconds: int,
    value: str,
    k: int,
    order: Sequence[str],
    *,
    keys: Sequence[str] = (),
    emit_remainder: bool = False,
    **scan,
) -> DataFrame:
    """Sum and count of each run of ``k`` rows inside a tumbling window (and key), in ``order``.

    ``window_start, window_end, *keys, firing, total, n``; ``firing`` counts from 0. The last rows of
    a window, fewer than ``k``, fire only with ``emit_remainder``. A window of any size is numbered
    in parallel (see ``scan``); the sums are combined before their shuffle.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    needed = df.select(*dict.fromkeys([*keys, ts, value, *order]))
    group = ["window_start", "window_end", *keys]
    numbered = prefix_scan(
        with_window(needed, ts, seconds), group, order, {"_rn": ("count", F.lit(1))}, **scan
    )
    sums = (
        numbered.withColumn("firing", F.call_function("div", F.col("_rn") - 1, F.lit(k)))
        .groupBy(*group, "firing")
        .agg(F.sum(value).alias("total"), F.count("*").alias("n"))
    )
    return sums if emit_remainder else sums.where(F.col("n") == k)
