"""Running aggregates per key over an ordered table, safe for hot keys.

A plain ``Window.partitionBy(key)`` puts each key into one task. Here a key with many rows is cut, in
its order, into chunks; each chunk is scanned in its own task and starts from the combined totals of
the chunks before it. Which chunk a row is in depends on the row alone, so retried tasks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 1_000_000
OVERSAMPLE = 16
# Cut points up to this many are broadcast (some 100 bytes each); more are joined by shuffle.
MAX_BROADCAST_CUTS = 500_000


def with_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_chunks: int | None = None,
    n_rows: int | None = None,
) -> DataFrame | None:
    """Add ``_chunk``, rising with ``order`` inside each key, and ``_cut`` (the key has chunks).

    Returns None when the whole input fits one chunk. ``order`` must be unique within a key.

    A fixed hash picks about one row in ``target / 16``; a key with at least 16 such rows is cut at
    every 16th of them. A row finds its chunk by binary search in its key's sorted array. Chunks have
    about ``rows_per_chunk`` rows however many that makes, unless ``max_chunks`` says how many at most.
    The cut points are broadcast while they are few by the number of rows, and joined by shuffle beyond.
    """
    n = df.count() if n_rows is None else n_rows
    if n <= rows_per_chunk:
        return None
    target = max(rows_per_chunk, -(-n // max_chunks) if max_chunks else 0)
    every = max(1, target // OVERSAMPLE)

    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    names = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    columns = [F.col(k) for k in keys] or [_one_key(order)]
    cuts = (
        df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
        .groupBy(*[c.alias(name) for c, name in zip(columns, names)])
        .agg(F.sort_array(F.collect_list(position)).alias("_s"))
        .where(F.size("_s") >= OVERSAMPLE)
        .select(*names, F.filter("_s", lambda _, i: i % OVERSAMPLE == OVERSAMPLE - 1).alias("_cuts"))
    )
    found = df.join(_few(cuts, n // target), _same_keys(keys, order), "left").select(
        *df.columns, "_cuts", position.alias("_at"), F.lit(0).alias("_chunk")
    )
    # One projection per step, each using the one before: generated code that reads the broadcast
    # array in place. A lambda over the steps would copy the array into every row.
    # Steps for 4 times the expected cut points; beyond that the last chunk would only be larger.
    for bit in reversed(range((4 * -(-n // target)).bit_length())):
        probe = F.col("_chunk") + (1 << bit)
        found = found.withColumn(
            "_chunk",
            F.when(F.get("_cuts", probe - 1) <= F.col("_at"), probe).otherwise(F.col("_chunk")),
        )
    # A generator with one row keeps the optimizer from unfolding the steps into what is above.
    chunk = F.struct(F.col("_chunk"), F.col("_cuts").isNotNull().alias("_cut"))
    return found.select(*df.columns, F.inline(F.array(chunk)))


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_CUTS else df


def _one_key(order: Sequence[str]) -> Column:
    """Always 0, but not a literal: the optimizer would leave it out, and the join would have no key."""
    return F.pmod(F.xxhash64(*order), F.lit(1))


def _same_keys(keys: Sequence[str], order: Sequence[str]) -> Column:
    if not keys:
        return _one_key(order) == F.col("_k0")
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return match


def _both(how: str, here: Column, before: Column) -> Column:
    """Combine a chunk-local aggregate with that of the chunks before it; nulls mean 'no rows'."""
    if how in ("sum", "count"):
        return F.coalesce(here + before, here, before)
    if how == "max":
        return F.greatest(here, before)
    if how == "min":
        return F.least(here, before)
    return F.coalesce(here, before)


def _local(how: str, column: Column) -> Column:
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "last": F.last}[how](column)


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, Column]],
    *,
    include_current: bool = True,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_chunks: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Add running aggregates over the rows of the same key up to (or before) each row (batch).

    ``outputs`` maps a new column to ``(how, column)`` with ``how`` one of ``sum``, ``count``,
    ``max``, ``min`` or ``last``. ``keys=[]`` scans the whole table as one sequence. ``order`` must be
    unique within a key. One shuffle of the rows; for tables above ``rows_per_chunk`` rows also one
    narrow read for the cut points and one, of the cut keys only, for the chunk totals. ``n_rows``
    saves the counting pass when the caller knows the size.
    """
    outputs = {
        name: (how, F.struct(column.alias("v")) if how == "last" else column)
        for name, (how, column) in outputs.items()
    }
    last_row = Window.currentRow if include_current else -1
    n_rows = df.count() if n_rows is None else n_rows
    chunked = with_chunks(
        df, keys, order, rows_per_chunk=rows_per_chunk, max_chunks=max_chunks, n_rows=n_rows
    )
    if chunked is None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last_row)
        scanned = df.withColumns({n: _local(how, c).over(frame) for n, (how, c) in outputs.items()})
        return _unwrap(scanned, df.columns, outputs)

    frame = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, last_row)
    )
    here = chunked.withColumns({n: _local(how, c).over(frame) for n, (how, c) in outputs.items()})

    key_columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] or [_one_key(order).alias("_k0")]
    key_names = [f"_k{i}" for i in range(len(key_columns))]
    totals = (
        chunked.where("_cut")
        .groupBy(*key_columns, F.col("_chunk").alias("_c"))
        .agg(
            *[
                (F.max_by(c, F.struct(*order)) if how == "last" else _local(how, c)).alias(f"_t_{n}")
                for n, (how, c) in outputs.items()
            ]
        )
    )
    # One row per chunk.
    before = (
        Window.partitionBy(*key_names).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    )
    merge_how = {"count": "sum"}
    carried = totals.select(
        *key_names,
        "_c",
        *[
            _local(merge_how.get(how, how), F.col(f"_t_{n}")).over(before).alias(f"_b_{n}")
            for n, (how, _) in outputs.items()
        ],
    )
    joined = here.join(
        _few(carried, n_rows // rows_per_chunk), _same_keys(keys, order) & (F.col("_chunk") == F.col("_c")), "left"
    )
    combined = joined.select(
        *df.columns,
        *[
            _both(how, F.col(n), F.col(f"_b_{n}")).alias(n) for n, (how, _) in outputs.items()
        ],
    )
    return _unwrap(combined, df.columns, outputs)


def _unwrap(df: DataFrame, columns: Sequence[str], outputs: dict) -> DataFrame:
    return df.select(
        *columns,
        *[F.col(n)["v"].alias(n) if how == "last" else F.col(n) for n, (how, _) in outputs.items()],
    )
