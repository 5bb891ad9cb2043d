"""User-defined aggregates on streams: accumulators of the user's schema in the engine's keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallybrook.functions.times import micros_as_timestamps, timestamps_as_micros
from tallybrook.operators.fold import FLUSH_ROWS, partial_folds
from tallybrook.operators.windows import with_window
from tallybrook.streaming.ordered import fold_keys

BUCKETS, PAGE = 512, 256  # state is dealt to so many buckets of keys, and in a bucket to pages of about so many keys


def _python(value):
    """A value of a pandas frame as one that state and rows take."""
    if value is None or (not isinstance(value, (list, dict, tuple)) and pd.isna(value) and not isinstance(value, float)):
        return None
    return value.item() if hasattr(value, "item") else value


def _values(column: pd.Series) -> list:
    plain = isinstance(column.dtype, np.dtype) and column.dtype.kind in "biuf"
    return column.tolist() if plain else [_python(v) for v in column]


def _same(value):
    """Equal for key values that group together: NaN is one value."""
    if isinstance(value, (list, tuple)):
        return tuple(map(_same, value))
    return "NaN" if value != value else value


class _Fold(StatefulProcessor):
    """Many keys at a time: a bucket of keys by their hash has its accumulators on pages of about ``per_page`` keys.

    A batch reads and writes the pages that its keys are on. Their number doubles with the keys, so what a key
    costs does not depend on how many there are.
    """

    def __init__(self, keys, kinds, merge, result, shown, buckets, per_page):
        self.keys, self.kinds, self.buckets, self.per_page = keys, kinds, buckets, per_page
        self.merge, self.result, self.shown = merge, result, shown
        plain = (T.IntegralType, T.StringType, T.BooleanType, T.DateType)
        self.same = tuple if all(isinstance(kinds[k].dataType, plain) for k in keys) else _same

    def init(self, handle) -> None:
        self.size = handle.getValueState("size", "pages int, n bigint")
        self.pages = handle.getMapState("accumulators", "page int", T.StructType([T.StructField("rows", T.ArrayType(self.kinds))]))
        self.names = self.kinds.names[1:]

    def page(self, at: int) -> list[tuple]:
        found = self.pages.getValue((at,))
        return [] if found is None else [tuple(row) for row in found[0]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pages, n = self.size.get() or (1, 0)
        low, high = 1, 1 + len(self.keys)
        new = [(number, *values) for *values, number, _ in rows]
        at = {row[0] // self.buckets % pages for row in new}
        held = {(row[0], self.same(row[low:high])): [row] for p in at for row in self.page(p)}
        before, parts = len(held), {}
        for row in new:
            mine = row[0], self.same(row[low:high])
            if mine not in parts:
                parts[mine] = held.setdefault(mine, [])
            parts[mine].append(row)
        n += len(held) - before
        for mine, folded, out in self.folded(parts):
            held[mine] = [folded]
            yield self.row(*folded[low:high], *out)
        if n > self.per_page * pages:
            rest = (row for p in range(pages) if p not in at for row in self.page(p))
            held.update({(row[0], self.same(row[low:high])): [row] for row in rest})
            pages = 1 << (n // self.per_page).bit_length()
            at = set(range(pages))
        lists = {p: [] for p in at}
        for (row,) in held.values():
            lists[row[0] // self.buckets % pages].append(row)
        for p, kept in lists.items():
            self.pages.updateValue((p,), (kept,))
        self.size.update((pages, n))

    def folded(self, parts: dict) -> Iterator[tuple]:
        """Each key of ``parts`` with its accumulator and its result.

        A frame holds keys alike in what is null in all, some or none of their rows, so its columns have the types that
        those of a key alone would have.
        """
        alike = {}
        for mine, rows in parts.items():
            if any(None in row for row in rows):
                nulls = [sum(v is None for v in column) for column in zip(*rows)]
                kind = (len(rows) > 1, *((k > 0) + (k == len(rows)) for k in nulls))
            else:
                kind = (len(rows) > 1, *[0] * len(rows[0]))
            alike.setdefault(kind, []).append(mine)
        for (several, _, *nulls), group in alike.items():
            merged = pd.DataFrame([row[1:] for mine in group for row in parts[mine]], columns=self.names)
            if several:
                merged = self.merge(merged)[self.names].reset_index(drop=True)
            done = self.result(merged)
            named = {mine[1]: (mine, parts[mine][0][: 1 + len(self.keys)]) for mine in group}
            keyed = lambda df: zip(*([None] * len(df) if null == 2 else _values(df[k]) for k, null in zip(self.keys, nulls)))  # noqa: B023, E731
            values = zip(*(_values(merged[name]) for name in self.names[len(self.keys) :]))
            of_key = keyed(done if {*self.keys} <= {*done.columns} else merged)
            results = dict(zip(map(self.same, of_key), zip(*(_values(done[name]) for name in self.shown))))
            for found, held in zip(map(self.same, keyed(merged)), values, strict=True):
                mine, own = named.pop(found)
                yield mine, (*own, *held), results[found]
            if named:
                raise ValueError(f"merge gave no row for {len(named)} keys")

    def close(self) -> None:
        pass


def fold_stream(
    df: DataFrame,
    keys: Sequence[str],
    *,
    add: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    result: Callable[[pd.DataFrame], pd.DataFrame],
    accumulator: T.StructType | str,
    output: T.StructType | str,
    flush_rows: int = FLUSH_ROWS,
    buckets: int = BUCKETS,
    keys_per_page: int = PAGE,
) -> DataFrame:
    """Twin of ``fold.fold_agg`` with the same user code: ``*keys, *output`` of each key that a batch changed.

    A task folds its rows of a batch into one accumulator for each key, so a key with most rows costs as many state
    merges as there are tasks. ``merge`` and ``result`` are given many keys at a time, as there. Keys of type TIMESTAMP
    are microseconds for the user's ``merge`` and ``result``; accumulators should have none. State is kept for ever,
    in ``buckets`` that a task takes one at a time; their number stays as it was when the stream first started.
    """
    keys = list(keys)
    kinds = [T.StructType.fromDDL(x) if isinstance(x, str) else x for x in (accumulator, output)]
    partials = partial_folds(df, keys, add=add, merge=merge, accumulator=kinds[0], flush_rows=flush_rows)
    spare = "_" * (1 + max(map(len, partials.columns)))  # no column's name
    bucket, number = f"{spare}bucket", F.xxhash64(*keys)
    dealt = timestamps_as_micros(partials).withColumns({spare: number, bucket: F.pmod(number, F.lit(buckets))})
    held = T.StructType([dealt.schema[name] for name in (spare, *partials.columns)])
    shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds[1])
    folded = fold_keys(dealt, [bucket], _Fold(keys, held, merge, result, kinds[1].names, buckets, keys_per_page), keys, shown)
    return micros_as_timestamps(folded, partials.select(*keys))


def fold_windows_stream(df: DataFrame, ts: str, seconds: int, keys: Sequence[str], **fold) -> DataFrame:
    """:func:`fold_stream` per tumbling window and key; windows stay open, and each batch gives those it changed."""
    return fold_stream(with_window(df, ts, seconds), ["window_start", "window_end", *keys], **fold)
