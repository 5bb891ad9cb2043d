"""Windows on streams that need own state: firing on a row count, and firing while idle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallybrook.operators.windows import with_window
from tallybrook.streaming.ordered import fold_keys, in_order


class _CountTrigger(StatefulProcessor):
    def __init__(self, order, value, k, echo, clear_at_end, emit_remainder):
        self.order, self.value, self.k, self.echo = order, value, k, echo
        self.clear_at_end, self.emit_remainder = clear_at_end, emit_remainder

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "firing bigint, n bigint, total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get()
        firing, n, total = held or (0, 0, None)
        for row in in_order(rows, self.order):
            if held is None and self.clear_at_end:
                held = (firing, n, total)
                self.handle.registerTimer(row["_end_ms"])
            value = row[self.value]
            if self.echo:
                yield self.row(*key, "input", firing, value, 1)
            n = n + 1
            total = value if total is None else total if value is None else total + value
            if n == self.k:
                yield self.row(*key, "sum", firing, total, n)
                firing, n, total = firing + 1, 0, None
        self.state.update((firing, n, total))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        firing, n, total = self.state.get() or (0, 0, None)
        self.state.clear()
        if n and self.emit_remainder:
            yield self.row(*key, "sum", firing, total, n)

    def close(self) -> None:
        pass


def count_trigger_stream(
    df: DataFrame,
    ts: str,
    seconds: int,
    value: str,
    k: int,
    order: Sequence[str],
    *,
    keys: Sequence[str] = (),
    echo: bool = False,
    clear_at_end: bool = False,
    emit_remainder: bool = False,
) -> DataFrame:
    """Sum and count of every ``k`` rows of a window (and key), as they arrive.

    ``window_start, window_end, *keys, kind, firing, total, n`` for an integer ``value``; ``kind`` is
    ``sum``, and with ``echo`` also ``input``, one row per input row, so that one query feeds both
    outputs. With ``clear_at_end`` a timer at the window's end (processing time; for an ingest-time
    ``ts``) forgets the rows that did not fill a firing, or emits them with ``emit_remainder``; it
    needs a ``processingTime`` trigger, as under ``availableNow`` the stream would never end.
    Without it replays give the same result however the input is cut into batches.
    The rows that one window and key have in a batch fold in one task; for large ones see
    ``streaming.carried``.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if emit_remainder and not clear_at_end:
        raise ValueError("emit_remainder needs clear_at_end on a stream")
    names = ["window_start", "window_end", *keys]
    needed = (
        with_window(df.select(*dict.fromkeys([*keys, ts, value, *order])), ts, seconds)
        .withColumn(value, F.col(value).cast("bigint"))
        .select(
            *dict.fromkeys([*names, *order, value]), F.unix_millis("window_end").alias("_end_ms")
        )
    )
    return fold_keys(
        needed,
        names,
        _CountTrigger(list(order), value, k, echo, clear_at_end, emit_remainder),
        names,
        "kind string, firing bigint, total bigint, n bigint",
        "processingTime" if clear_at_end else "none",
    )


class _IdleWindow(StatefulProcessor):
    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "n bigint, total double, largest double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get()
        for row in rows:
            if held is None:
                held = (row["n"], row["total"], row["largest"])
                self.handle.registerTimer(row["_end_ms"])
            else:
                # NaN is the largest, as in the built-in maximum.
                largest = max((held[2], row["largest"]), key=lambda v: (v != v, v))
                held = (held[0] + row["n"], held[1] + row["total"], largest)
        self.state.update(held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        totals = self.state.get()
        self.state.clear()
        yield self.row(*key, *totals)

    def close(self) -> None:
        pass


def window_agg_when_idle(
    df: DataFrame, ts: str, seconds: int, keys: Sequence[str], value: str
) -> DataFrame:
    """Count, sum and maximum per window and key, out when the clock passes the window's end.

    ``window_start, window_end, *keys, n, total, largest``; null values are left out.
    ``windows.window_agg`` needs later rows to close a window; this one fires by itself, so ``ts``
    should be the ingest time, and the trigger ``processingTime``. Rows are combined inside each task before the shuffle.
    """
    names = ["window_start", "window_end", *keys]
    needed = (
        with_window(df.select(*dict.fromkeys([*keys, ts, value])), ts, seconds)
        .where(F.col(value).isNotNull())
        .select(
            *names, F.unix_millis("window_end").alias("_end_ms"), F.col(value).cast("double").alias("_v")
        )
    )
    totals = "n bigint, total double, largest double"
    combined = T.StructType(
        [needed.schema[n] for n in [*names, "_end_ms"]] + T.StructType.fromDDL(totals).fields
    )

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # pandas would skip NaN, which makes a sum and a maximum NaN.
            batch["_nan"] = batch["_v"].isna()
            grouped = batch.groupby([*names, "_end_ms"], dropna=False, sort=False)
            out = grouped.agg(n=("_v", "size"), total=("_v", "sum"), largest=("_v", "max"), nan=("_nan", "any")).reset_index()
            out.loc[out["nan"], ["total", "largest"]] = float("nan")
            yield out.drop(columns="nan")

    return fold_keys(
        needed.mapInPandas(combine, combined), names, _IdleWindow(), names, totals, "processingTime"
    )
