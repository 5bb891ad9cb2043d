"""One watermark over several inputs: the least of their largest times, without inputs that are idle (batch)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import seconds_interval
from tallybrook.operators.late import GLOBAL_ROWS_PER_CHUNK
from tallybrook.operators.scan import prefix_scan
from tallybrook.operators.windows import with_window


def common_time(
    df: DataFrame, ts: str, arrival: str, order: Sequence[str], source: str, sources: Sequence, *, idle_seconds: int, **scan
) -> DataFrame:
    """Add ``common_ts``: how far all inputs had come before each row, in arrival order; null before that.

    ``sources`` are the values of ``source``, a few. An input is idle when nothing has come from it for ``idle_seconds``, up to
    the row's own arrival, or since the first row if nothing ever has. The common time never goes back: an input that
    wakes up behind it does not lower it, and while all are idle it stays. ``order`` is unique and begins with ``arrival``.
    """
    scan = {"rows_per_chunk": GLOBAL_ROWS_PER_CHUNK, "n_rows": scan.pop("n_rows", None) or df.count(), **scan}
    marks = {"_first": ("min", F.col(arrival))}
    for i, name in enumerate(sources):
        own = F.col(source) == F.lit(name)
        marks |= {f"_m{i}": ("max", F.when(own, F.col(ts))), f"_a{i}": ("max", F.when(own, F.col(arrival)))}
    seen = prefix_scan(df, [], order, marks, include_current=False, **scan)
    states = []
    for i in range(len(sources)):
        last = F.coalesce(F.col(f"_a{i}"), F.col("_first"))
        states.append((F.coalesce(last + seconds_interval(idle_seconds) >= F.col(arrival), F.lit(False)), F.col(f"_m{i}")))
    waits = reduce(lambda a, b: a | b, [active & mark.isNull() for active, mark in states])
    least = F.least(*[F.when(active, mark) for active, mark in states]) if len(states) > 1 else F.when(*states[0])
    common = seen.select(*df.columns, F.when(~waits, least).alias("_common"))
    return prefix_scan(common, [], order, {"common_ts": ("max", F.col("_common"))}, **scan).drop("_common")


def split_late_inputs(
    df: DataFrame,
    ts: str,
    arrival: str,
    order: Sequence[str],
    source: str,
    sources: Sequence,
    seconds: int,
    *,
    idle_seconds: int,
    delay_seconds: int = 0,
    lateness_seconds: int = 0,
    **scan,
) -> DataFrame:
    """Add ``common_ts, window_start, window_end, is_late``; the rule is that of ``late.split_late`` by the common time."""
    marked = common_time(df, ts, arrival, order, source, sources, idle_seconds=idle_seconds, **scan)
    closed = F.col("window_end") + seconds_interval(delay_seconds + lateness_seconds)
    return with_window(marked, ts, seconds).withColumn("is_late", F.coalesce(F.col("common_ts") >= closed, F.lit(False)))
