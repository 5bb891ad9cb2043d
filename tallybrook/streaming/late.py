"""Late rows of a stream as data. Rules and terms as in ``operators.late``, per key.

Spark's own watermark moves only between batches and drops late rows unseen, so the largest time so
far is kept as state here. For one sequence over all keys, or hot keys, see ``streaming.carried``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tallybrook.streaming.ordered import fold_keys, in_order


class _SplitLate(StatefulProcessor):
    """Times in microseconds. A window is held as ``[n, total, revision]``; -1 is not emitted yet."""

    def __init__(self, keys, order, width, delay, lateness):
        self.keys, self.order = keys, order
        self.width, self.delay, self.lateness = width, delay, lateness

    def init(self, handle) -> None:
        self.largest = handle.getValueState("largest", "us bigint")
        self.windows = handle.getMapState(
            "windows", "start bigint", "n bigint, total double, revision int"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.largest.get()
        largest = held[0] if held else None
        stored = {start: list(window) for (start,), window in self.windows.iterator()}
        windows = {start: list(window) for start, window in stored.items()}
        waiting = [start for start, window in windows.items() if window[2] < 0]
        heapq.heapify(waiting)
        no_row = [None] * len(self.order)

        def result(start: int) -> Row:
            n, total, revision = windows[start]
            return self.row(*key, *no_row, "window", None, None, None, start, n, total, revision)

        for row in in_order(rows, self.order):
            ts, value = row["_ts"], row["_value"]
            start = ts - ts % self.width
            closing = start + self.width + self.delay
            is_late = largest is not None and largest >= closing + self.lateness
            yield self.row(
                *key, *[row[o] for o in self.order], "late" if is_late else "on_time",
                ts, value, largest, start, None, None, None,
            )
            if is_late:
                continue
            if start not in windows:
                windows[start] = [0, 0.0, -1]
                heapq.heappush(waiting, start)
            window = windows[start]
            window[0] += 1
            window[1] += value or 0.0
            if largest is not None and largest >= closing:
                window[2] += 1
                yield result(start)
            largest = ts if largest is None else max(largest, ts)
            while waiting and waiting[0] + self.width + self.delay <= largest:
                done = heapq.heappop(waiting)
                if windows[done][2] < 0:
                    windows[done][2] = 0
                    yield result(done)

        self.largest.update((largest,))
        for start, window in windows.items():
            if start + self.width + self.delay + self.lateness <= largest:
                if start in stored:
                    self.windows.removeKey((start,))
            elif stored.get(start) != window:
                self.windows.updateValue((start,), tuple(window))

    def close(self) -> None:
        pass


def split_late_stream(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    value: str,
    seconds: int,
    keys: Sequence[str],
    *,
    delay_seconds: int = 0,
    lateness_seconds: int = 0,
) -> DataFrame:
    """Tagged rows of three kinds, per key.

    ``on_time`` and ``late``: each input row with its window and the largest earlier time.
    ``window``: count and sum of a window when it closes (``revision`` 0), and again for each row
    accepted after that. Columns: ``*keys, *order, kind, ts, value, prior_max_ts, window_start,
    window_end, n, total, revision``; those of the other kind are null.
    Windows still open when the input ends are not emitted. Rows without a time are left out.
    """
    order = [o for o in order if o not in keys]
    needed = df.where(F.col(ts).isNotNull()).select(
        *keys, *order, F.unix_micros(ts).alias("_ts"), F.col(value).cast("double").alias("_value")
    )
    micros = [1_000_000 * s for s in (seconds, delay_seconds, lateness_seconds)]
    tagged = fold_keys(
        needed,
        keys,
        _SplitLate(list(keys), order, *micros),
        [*keys, *order],
        "kind string, ts_us bigint, value double, prior_us bigint, start_us bigint, "
        "n bigint, total double, revision int",
    )
    return tagged.select(
        *keys,
        *order,
        "kind",
        F.timestamp_micros("ts_us").alias("ts"),
        "value",
        F.timestamp_micros("prior_us").alias("prior_max_ts"),
        F.timestamp_micros("start_us").alias("window_start"),
        F.timestamp_micros(F.col("start_us") + seconds * 1_000_000).alias("window_end"),
        "n",
        "total",
        "revision",
    )
