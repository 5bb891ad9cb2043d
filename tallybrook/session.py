"""Session defaults and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app: str = "tallybrook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` adds or replaces settings.

    ``spark.sql.shuffle.partitions`` is left to the cluster: for batch work AQE coalesces it, for
    streams it fixes the number of state partitions, so it should be about 2-3x the cores there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, unique to this call.

    The setting is the cluster's. Without it the folder lies in the warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Select the RocksDB state store, which ``transformWithState`` needs, while a query starts."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
