"""Lookup in a dimension that changes: the value that was valid at a row's time (batch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.times import epoch_micros
from tallybrook.operators.scan import prefix_scan


def as_of(
    df: DataFrame,
    ts: str,
    id: str,
    changes: DataFrame,
    changed: str,
    change_id: str,
    keys: Sequence[str],
    value: str,
    *,
    default=None,
    out: str | None = None,
    **scan,
) -> DataFrame:
    """``df`` with the ``value`` of the last row of ``changes`` of the same ``keys`` whose time is not after the row's.

    Changes and rows are one sequence in time, a change before the rows of its time, and the last value is
    carried along it (see ``scan``), so a key with most rows or changes is split over tasks and neither side is broadcast.
    ``id`` and ``change_id`` are integers, unique within a key; of changes of one time the largest id counts. Null keys are a key. A row
    without a time, or before all changes, gets ``default``, as does one whose value is null.
    """
    name = out or value
    own = {c: f"_{i}" for i, c in enumerate(df.columns)}
    asked = df.select(
        *[F.col(c).alias(f"_k{i}_") for i, c in enumerate(keys)],
        epoch_micros(df, ts).alias("_when"),
        F.lit(1).alias("_kind"),
        F.col(id).cast("bigint").alias("_id"),
        F.lit(None).cast(changes.schema[value].dataType).alias("_value"),
        F.struct(*[F.col(c).alias(own[c]) for c in df.columns]).alias("_row"),
    )
    told = changes.where(F.col(changed).isNotNull()).select(
        *[F.col(c).alias(f"_k{i}_") for i, c in enumerate(keys)],
        epoch_micros(changes, changed).alias("_when"),
        F.lit(0).alias("_kind"),
        F.col(change_id).cast("bigint").alias("_id"),
        F.col(value).alias("_value"),
    )
    # Only changes set the value: a row's own null must not end it.
    both = asked.unionByName(told, allowMissingColumns=True).withColumn(
        "_set", F.when(F.col("_kind") == 0, F.struct("_when", "_id", F.col("_value").alias("v")))
    )
    names = [f"_k{i}_" for i in range(len(keys))]
    # The latest change so far is the largest by time and id.
    scanned = prefix_scan(both, names, ["_when", "_kind", "_id"], {"_valid": ("max", F.col("_set"))}, **scan)
    found = F.when(F.col("_when").isNotNull(), F.col("_valid.v"))
    if default is not None:
        found = F.coalesce(found, F.lit(default))
    return scanned.where("_kind = 1").select(*[F.col(f"_row.{own[c]}").alias(c) for c in df.columns if c != name], found.alias(name))
