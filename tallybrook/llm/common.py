"""What the operators share: cut lineages, bounded chunks of texts, and whole numbers of groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybrook.session import shared_folder

CHUNK_BYTES = 4 << 20


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps do not run it a second time.

    A lost executor costs nothing that is written; there is no copy that only one executor holds.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def groups_of(rows: int, rows_per_group: int) -> int:
    return max(1, -(-rows // rows_per_group))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of ``column``; a longer value is alone in its slice."""
    array = batch.column(column)
    if not len(array):
        return
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    start = 0
    while start < len(array):
        stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(array))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more entry: the end)."""
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]
