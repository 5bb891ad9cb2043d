"""Random integers from a source of its own: one loop for each instance, one number per delay, replayed alike."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "id long, instance int, tick long, at_ms long, v int"


def draw(id: int, low: int, high: int, seed: int) -> int:
    """The same number as ``sources.random_int``."""
    return low + int(hashlib.md5(f"{id}|{seed}".encode()).hexdigest()[:8], 16) % (high - low + 1)


class _Loop(InputPartition):
    def __init__(self, instance: int, start: int, end: int):
        self.instance, self.start, self.end = instance, start, end


class _Reader(DataSourceStreamReader):
    """An offset is a tick of the clock: how many delays have passed since the epoch.

    What a tick gives depends on the tick, the instance and the seed alone, so a batch that is run again from
    its logged offsets has the same rows, and a restart goes on where the last offset ended.
    """

    def __init__(self, options: dict):
        self.instances = int(options.get("instances", 2))
        self.delay_ms = int(options.get("delay_ms", 500))
        self.low, self.high = int(options.get("low", 1)), int(options.get("high", 10))
        self.seed = int(options.get("seed", 0))
        if self.low > self.high or self.instances < 1 or self.delay_ms < 1:
            raise ValueError("need low <= high, an instance and a delay of a millisecond at least")

    def _now(self) -> dict:
        return {"tick": time.time_ns() // 1_000_000 // self.delay_ms}

    def initialOffset(self) -> dict:
        return self._now()

    def latestOffset(self) -> dict:
        return self._now()

    def partitions(self, start: dict, end: dict) -> list[_Loop]:
        return [_Loop(i, start["tick"], end["tick"]) for i in range(self.instances)]

    def read(self, partition: _Loop) -> Iterator[tuple]:
        for tick in range(partition.start, partition.end):
            id = tick * self.instances + partition.instance
            yield id, partition.instance, tick, tick * self.delay_ms, draw(id, self.low, self.high, self.seed)

    def commit(self, end: dict) -> None:
        """Nothing is held for rows that were taken."""


class RandomIntegers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "random_integers"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def random_loops(
    spark: SparkSession, low: int = 1, high: int = 10, *, seed: int = 0, instances: int = 2, delay_ms: int = 500
) -> DataFrame:
    """An endless stream ``id, instance, ts, v``: each instance is a task that draws a number every ``delay_ms``.

    ``ts`` is the time of the tick. After a pause the ticks that passed meanwhile come in one batch.
    """
    spark.dataSource.register(RandomIntegers)
    options = {"low": low, "high": high, "seed": seed, "instances": instances, "delay_ms": delay_ms}
    rows = spark.readStream.format(RandomIntegers.name()).options(**{k: str(v) for k, v in options.items()}).load()
    return rows.select("id", "instance", F.timestamp_millis("at_ms").alias("ts"), "v")
