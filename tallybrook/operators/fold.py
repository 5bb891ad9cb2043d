"""User code: aggregates and row functions in Arrow batches, and functions of a window's rows (batch input)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.times import micros_as_timestamps, timestamps_as_micros
from tallybrook.operators.windows import with_window

FLUSH_ROWS = 50_000


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def fold_agg(
    df: DataFrame,
    keys: Sequence[str],
    *,
    add: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    result: Callable[[pd.DataFrame], pd.DataFrame],
    accumulator: T.StructType | str,
    output: T.StructType | str,
    flush_rows: int = FLUSH_ROWS,
) -> DataFrame:
    """Aggregate with user code that can merge partial results.

    ``add`` turns a batch of rows into one row of ``keys`` and accumulator columns per key, ``merge``
    turns several accumulator rows per key into one, ``result`` turns finished accumulator rows into
    ``output`` columns. Each works on a pandas frame that holds many keys. ``merge`` must be
    associative and commutative.

    Accumulators are built and merged inside each task; only they are shuffled. Behind the shuffle
    they come sorted by key and are merged batch by batch, holding back the batch's last key, so
    neither many keys nor one hot key need more memory than a few batches.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    out_type = T.StructType(key_fields + _struct(output).fields)
    out_names = out_type.names
    partials = partial_folds(df, keys, add=add, merge=merge, accumulator=accumulator, flush_rows=flush_rows)
    acc_names = partials.columns

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = pd.Series(True, index=rows.index)
            for k in keys:
                end = rows[k].iloc[-1]
                last &= rows[k].isna() if pd.isna(end) else rows[k] == end
            if not last.all():
                yield result(merge(rows[~last])[acc_names])[out_names]
            held = merge(rows[last])[acc_names]
        if held is not None:
            yield result(held)[out_names]

    return (
        partials.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(final, out_type)
    )


def partial_folds(
    df: DataFrame,
    keys: Sequence[str],
    *,
    add: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    accumulator: T.StructType | str,
    flush_rows: int = FLUSH_ROWS,
) -> DataFrame:
    """Accumulators of what each task has of a key (batch or stream): ``keys`` and the accumulator's columns."""
    acc_type = T.StructType([df.schema[k] for k in keys] + _struct(accumulator).fields)
    acc_names = acc_type.names

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            if len(batch):
                held.append(add(batch)[acc_names])
                rows += len(held[-1])
            if rows > flush_rows:
                merged = merge(pd.concat(held, ignore_index=True))[acc_names]
                if len(merged) > flush_rows // 2:
                    yield merged
                    held, rows = [], 0
                else:
                    held, rows = [merged], len(merged)
        if held:
            yield merge(pd.concat(held, ignore_index=True))[acc_names]

    return df.mapInPandas(partial, acc_type)


def fold_windows(df: DataFrame, ts: str, seconds: int, keys: Sequence[str], **fold) -> DataFrame:
    """:func:`fold_agg` per tumbling window and key; the bounds are key columns."""
    return fold_agg(with_window(df, ts, seconds), ["window_start", "window_end", *keys], **fold)


def flat_map(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], output: T.StructType | str
) -> DataFrame:
    """Apply a user function that returns any number of rows for a batch of rows (also streams)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, output)


class WindowProcess:
    """User code for the rows of one window and key, given one by one in order; holds what it needs itself."""

    def row(self, row: Row) -> Iterable[tuple]:
        """Output rows that this input row gives."""
        return ()

    def end(self) -> Iterable[tuple]:
        """Output rows when the window has no more rows."""
        return ()


def process_windows(
    df: DataFrame, ts: str, seconds: int, keys: Sequence[str], order: Sequence[str], process: Callable[[], WindowProcess], output: T.StructType | str
) -> DataFrame:
    """``window_start, window_end, *keys, *output``: what user code makes of each tumbling window, row by row.

    A table function partitioned by window and key and ordered by ``order``: Spark shuffles and sorts, with spill, and
    gives each partition's rows one after the other to a ``process()`` of its own, so a window of any size needs no
    more memory than the user's code holds. Times of type TIMESTAMP are microseconds there.
    """
    names = ["window_start", "window_end", *keys]
    windowed = with_window(df, ts, seconds).where(F.col("window_start").isNotNull())
    plain = timestamps_as_micros(windowed)
    shown = T.StructType([plain.schema[n] for n in names] + _struct(output).fields)

    class Handler:
        def __init__(self):
            self.user, self.key = None, ()

        def eval(self, row: Row):
            if self.user is None:
                self.user, self.key = process(), tuple(row[n] for n in names)
            for out in self.user.row(row):
                yield (*self.key, *out)

        def terminate(self):
            if self.user is not None:
                for out in self.user.end():
                    yield (*self.key, *out)

    function = F.udtf(Handler, returnType=shown)
    done = function(plain.asTable().partitionBy(*names).orderBy(*order))
    return micros_as_timestamps(done, windowed.select(*names))
