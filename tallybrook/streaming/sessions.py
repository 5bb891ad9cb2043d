"""Sessions of a stream in keyed state: rows in any order, and sessions that meet merge with their accumulators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallybrook.functions.times import as_instant
from tallybrook.streaming.ordered import fold_keys

PANDAS = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
PLAIN = {"count": lambda a, b: a + b, "sum": lambda a, b: a + b, "min": min, "max": max}


class _Sessions(StatefulProcessor):
    """Times in microseconds. A session is held as its start -> (end, *values)."""

    def __init__(self, values: dict[str, str], held: str, keep: int | None):
        self.values, self.held, self.keep = values, held, keep

    def init(self, handle) -> None:
        self.state = handle.getMapState("sessions", "start bigint", self.held)

    def merged(self, a: tuple, b: tuple) -> tuple:
        pairs = zip(self.values.values(), a[1:], b[1:])
        return (max(a[0], b[0]), *[x if y is None else y if x is None else PLAIN[how](x, y) for how, x, y in pairs])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = {start: tuple(rest) for (start,), rest in self.state.iterator()}
        parts = [*stored.items(), *((row["session_start"], (row["session_end"], *[row[v] for v in self.values])) for row in rows)]
        now: dict[int, tuple] = {}
        first = None
        for start, rest in sorted(parts, key=lambda part: part[0]):
            if first is None or start > now[first][0]:
                first, now[start] = start, rest
            else:
                now[first] = self.merged(now[first], rest)
        latest = max(end for end, *_ in now.values())
        for start in stored.keys() - now.keys():
            self.state.removeKey((start,))
            yield self.row(*key, start, None, *[None] * len(self.values), True)
        for start, rest in now.items():
            if stored.get(start) != rest:
                yield self.row(*key, start, *rest, False)
            if self.keep is not None and rest[0] + self.keep < latest:
                if start in stored:
                    self.state.removeKey((start,))
            elif stored.get(start) != rest:
                self.state.updateValue((start,), rest)

    def close(self) -> None:
        pass


def session_stream(
    df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], values: dict[str, tuple[str, Column]], *, keep_seconds: int | None = None
) -> DataFrame:
    """Twin of ``sessions.sessions`` for numbers: what a batch changed, ``*keys, session_start, session_end, *values, merged``.

    A session that another one took in comes with ``merged`` true and nulls: it is no more. So the last row of each
    key and start, if that is not ``merged``, is the session so far, whatever the order and cut of the rows. Each task makes sessions of
    its rows of a batch first. Without ``keep_seconds`` state is kept for ever; with it, sessions that ended that long
    before the key's latest are forgotten, and a row that would still join one makes a session of its own.
    """
    how = {name: kind for name, (kind, _) in values.items()}
    timed = as_instant(df, ts).where(F.col(ts).isNotNull())
    start = {name: F.lit(1).cast("bigint") if kind == "count" else column for name, (kind, column) in values.items()}
    rows = timed.select(
        *keys, F.unix_micros(ts).alias("session_start"), *[column.alias(name) for name, column in start.items()]
    ).withColumn("session_end", F.col("session_start") + gap_seconds * 1_000_000)
    kinds = {name: "bigint" if isinstance(rows.schema[name].dataType, T.IntegralType) else "double" for name in values}
    rows = rows.select(*keys, "session_start", "session_end", *[F.col(n).cast(k).alias(n) for n, k in kinds.items()])
    columns, schema = rows.columns, rows.schema

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = list(keys)
        for batch in batches:
            if not len(batch):
                continue
            own = batch.sort_values("session_start", kind="stable")
            # All rows are as long, so a row begins a session where it begins after the row before it ends.
            before = own.groupby(by, dropna=False)["session_end"].shift() if by else own["session_end"].shift()
            own["_n"] = (before.isna() | (own["session_start"] > before)).astype("int64")
            own["_n"] = own.groupby(by, dropna=False)["_n"].cumsum() if by else own["_n"].cumsum()
            found = own.groupby([*by, "_n"], dropna=False, sort=False)
            made = found.agg({"session_start": "min", "session_end": "max"})
            for name, kind in how.items():
                made[name] = found[name].sum(min_count=1) if kind in ("count", "sum") else getattr(found[name], PANDAS[kind])()
            yield made.reset_index()[columns]

    named = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    processor = _Sessions(how, f"end bigint, {named}", None if keep_seconds is None else keep_seconds * 1_000_000)
    found = fold_keys(
        rows.mapInPandas(join, schema), keys, processor, keys, f"session_start bigint, session_end bigint, {named}, merged boolean"
    )
    times = {c: F.timestamp_micros(c) for c in ("session_start", "session_end")}
    return found.withColumns(times)
