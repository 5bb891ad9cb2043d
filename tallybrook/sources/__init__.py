"""Inputs: text files, line and table streams, random integers, dimension tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.times import as_instant


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line of the files at ``path`` (any Hadoop file system)."""
    return spark.read.text(path)


def line_stream(spark: SparkSession, path: str | None = None, *, format: str = "text", **options) -> DataFrame:
    """An unbounded stream of lines: ``value``, and the ingest time ``ts``.

    Default: new text files under the folder ``path``; set ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` to bound a batch. ``format="kafka"`` needs Spark's Kafka package.
    ``format="socket"`` (``host``, ``port``) is for trials only: it cannot be replayed after a failure.
    A last line without line break is a record too.
    """
    reader = spark.readStream.format(format)
    if format == "socket":
        options = {"includeTimestamp": True, **options}
    lines = (reader.options(**options).load(path) if path else reader.options(**options).load())
    if format == "kafka":
        return lines.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"))
    if format == "socket":
        return lines.select("value", F.col("timestamp").alias("ts"))
    return lines.select("value", F.current_timestamp().alias("ts"))


def table_stream(spark: SparkSession, path: str, ts: str | None = None, **options) -> DataFrame:
    """A parquet table as a stream of its files; ``ts`` names a time column to make an instant of.

    ``path`` may be one file or a folder of part files.
    """
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    # A file source given one file by name takes it for a base folder; a pattern works for both.
    stream = spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")
    return as_instant(stream, ts) if ts else stream


def random_int(id: Column, low: int, high: int, seed: int = 0) -> Column:
    """A uniform integer of ``[low, high]``, both included, drawn from a row's id and the seed.

    From the MD5 of "id|seed", so a retried task draws the same numbers, and other engines do too.
    """
    if low > high:
        raise ValueError(f"low {low} is above high {high}")
    digest = F.md5(F.concat_ws("|", id.cast("string"), F.lit(str(seed))).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (F.lit(low) + F.pmod(drawn, F.lit(high - low + 1))).cast("int")


def random_ints(spark: SparkSession, n: int, low: int = 1, high: int = 10, *, seed: int = 0) -> DataFrame:
    """``id, v`` for ids 0..n-1, made in parallel."""
    ids = spark.range(n)
    return ids.select("id", random_int(F.col("id"), low, high, seed).alias("v"))


def random_int_stream(
    spark: SparkSession, low: int = 1, high: int = 10, *, seed: int = 0, rows_per_second: int = 2, **options
) -> DataFrame:
    """An endless stream ``id, ts, v`` at a fixed rate (the default is one row per 500 ms)."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).options(**options).load()
    return rate.select(
        F.col("value").alias("id"),
        F.col("timestamp").alias("ts"),
        random_int(F.col("value"), low, high, seed).alias("v"),
    )


def dimension(spark: SparkSession, entries: Mapping[str, float], key: str = "product", value: str = "price") -> DataFrame:
    """A small constant dimension table."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.DoubleType())])
    return spark.createDataFrame(list(entries.items()), schema)
