"""Per-row results of keyed streams: running count, total and average, pair flags, top k.

The rows of a key that arrive in one batch are put into ``order`` first; a row that arrives in a
later batch counts as later, whatever its order. The results depend on that order, so one task folds
the rows that a key has in a batch: bound the batch with the source's ``maxFilesPerTrigger``,
``maxBytesPerTrigger`` or ``maxOffsetsPerTrigger``. For large batches or hot keys use
``streaming.carried``, or ``running.latest_total`` on the stream where one change per key and batch
is enough.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallybrook.functions.times import micros_as_timestamps, timestamps_as_micros


def in_order(rows: Iterable[Row], order: Sequence[str]) -> list[Row]:
    """Sorted by ``order``, nulls first."""
    return sorted(rows, key=lambda row: [(row[o] is not None, row[o]) for o in order])


def fold_keys(
    df: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    shown: Sequence[str],
    extra: str,
    time_mode: str = "none",
) -> DataFrame:
    """Run ``processor`` per key; its rows have the columns ``shown`` of ``df`` and then ``extra``."""
    plain = timestamps_as_micros(df)
    output = T.StructType([plain.schema[c] for c in shown] + T.StructType.fromDDL(extra).fields)
    processor.row = Row(*output.names)
    folded = plain.groupBy(*keys).transformWithState(processor, output, "append", time_mode)
    return micros_as_timestamps(folded, df)


class _Running(StatefulProcessor):
    def __init__(self, names, order, amount, whole, ttl_ms):
        self.names, self.order, self.amount, self.whole, self.ttl_ms = names, order, amount, whole, ttl_ms

    def init(self, handle) -> None:
        kind = "bigint" if self.whole else "double"
        self.state = handle.getValueState("totals", f"n bigint, total {kind}", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, total = self.state.get() or (0, 0 if self.whole else 0.0)
        for row in in_order(rows, self.order):
            amount = row[self.amount] if self.amount else 1
            if amount is not None:
                n, total = n + 1, total + amount
            yield self.row(*[row[c] for c in self.names], n, total, total / n if n else None)
        self.state.update((n, total))

    def close(self) -> None:
        pass


def running_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str | None = None,
    *,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """Every change of a key's count, total and average: ``*keys, *order, amount, n, total, average``.

    Integer amounts are added as 64-bit integers, others as doubles; null amounts do not count.
    Without an ``amount`` the total is the count. State is kept for ever, or until a key has been
    silent for ``ttl_seconds``; a stream whose state expires needs a ``processingTime`` trigger, as
    under ``availableNow`` it would never end.
    """
    names = list(dict.fromkeys([*keys, *order, *([amount] if amount else [])]))
    needed = df.select(*names)
    whole = not amount or isinstance(needed.schema[amount].dataType, T.IntegralType)
    kind = "bigint" if whole else "double"
    if amount:
        needed = needed.withColumn(amount, F.col(amount).cast(kind))
    ttl_ms = ttl_seconds and ttl_seconds * 1000
    return fold_keys(
        needed,
        keys,
        _Running(names, list(order), amount, whole, ttl_ms),
        names,
        f"n bigint, total {kind}, average double",
        "processingTime" if ttl_ms else "none",
    )


class _PairFlag(StatefulProcessor):
    def __init__(self, names, order, amount, small, large, gap_us):
        self.names, self.order, self.amount = names, order, amount
        self.small, self.large, self.gap_us = small, large, gap_us

    def init(self, handle) -> None:
        self.state = handle.getValueState("previous", "amount double, us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before, before_us = self.state.get() or (None, None)
        for row in in_order(rows, self.order):
            amount, us = row[self.amount], row["_us"] if self.gap_us is not None else None
            flagged = (
                before is not None and before < self.small and amount is not None and amount > self.large
            )
            if flagged and self.gap_us is not None:
                flagged = us is not None and before_us is not None and us - before_us <= self.gap_us
            yield self.row(*[row[c] for c in self.names], flagged)
            before, before_us = amount, us
        self.state.update((before, before_us))

    def close(self) -> None:
        pass


def flag_small_then_large_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    *,
    small: float,
    large: float,
    ts: str | None = None,
    max_gap_seconds: float | None = None,
) -> DataFrame:
    """Streaming twin of ``running.flag_small_then_large``: ``*keys, *order, amount, flagged``."""
    names = list(dict.fromkeys([*keys, *order, amount]))
    gap_us = None if max_gap_seconds is None else int(max_gap_seconds * 1_000_000)
    needed = df.select(
        *names, *([] if gap_us is None else [F.unix_micros(ts).alias("_us")])
    ).withColumn(amount, F.col(amount).cast("double"))
    processor = _PairFlag(names, list(order), amount, small, large, gap_us)
    return fold_keys(needed, keys, processor, names, "flagged boolean")


class _TopK(StatefulProcessor):
    def __init__(self, names, order, amount, k, held):
        self.names, self.order, self.amount, self.k, self.held = names, order, amount, k, held

    def init(self, handle) -> None:
        self.state = handle.getListState("best", self.held)

    def place(self, amount, position) -> tuple:
        """Sorts the largest amount first, NaN before all and null after all, then by position with nulls first."""
        known = amount is not None
        kind = 2 if not known else 0 if amount != amount else 1
        return kind, -amount if kind == 1 else 0.0, [(p is not None, p) for p in position]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [(self.place(amount, position), amount, tuple(position)) for amount, *position in self.state.get()]
        best = sorted(held, key=lambda entry: entry[0])
        changed = False
        for row in in_order(rows, self.order):
            amount, position = row[self.amount], tuple(row[o] for o in self.order)
            at = bisect.bisect_right([entry[0] for entry in best], self.place(amount, position))
            if at < self.k:
                best.insert(at, (self.place(amount, position), amount, position))
                del best[self.k :]
                changed = True
                yield self.row(*[row[c] for c in self.names], at + 1)
        if changed:
            self.state.put([(amount, *position) for _, amount, position in best])

    def close(self) -> None:
        pass


def top_k_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, k: int
) -> DataFrame:
    """Rows that are among their key's ``k`` largest when they arrive, with their ``rank`` then.

    ``*keys, *order, amount, rank``. The final top k of each key are among them: ``running.top_k``
    over the output gives it. Equal amounts rank by ``order`` and nulls last, as in that, whichever batch
    they come in.
    """
    names = list(dict.fromkeys([*keys, *order, amount]))
    needed = df.select(*names)
    needed = needed.withColumn(amount, F.col(amount).cast("double"))
    plain = timestamps_as_micros(needed)
    held = T.StructType([T.StructField("amount", T.DoubleType()), *[plain.schema[o] for o in order]])
    return fold_keys(needed, keys, _TopK(names, list(order), amount, k, held), names, "rank int")
