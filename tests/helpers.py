"""Small helpers: rows as sorted tuples, and tables cut into files that a stream reads in turn."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def lines(spark, *values: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "value string")


def at(seconds):
    """A TIMESTAMP column that many seconds after the epoch."""
    return F.timestamp_seconds(seconds)


def write_in_turn(df: DataFrame, folder: Path, bounds: list[int], position: str = "seq") -> str:
    """One parquet file per slice of ``position``, with rising file times. Returns the folder."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        part = df
        if low is not None:
            part = part.where(F.col(position) >= low)
        if high is not None:
            part = part.where(F.col(position) < high)
        part.coalesce(1).write.mode("overwrite").parquet(str(folder.parent / f"{folder.name}-{i}"))
        (source,) = (folder.parent / f"{folder.name}-{i}").glob("part-*.parquet")
        target = folder / f"{i:03d}.parquet"
        os.link(source, target)
        os.utime(target, (1_600_000_000 + i, 1_600_000_000 + i))
    return str(folder)
