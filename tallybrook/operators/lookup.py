"""Lookup of one value per key in a dimension table, with a default for unknown keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    *,
    default,
    dim_key: str | None = None,
    out: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``value`` of the ``dim`` row whose ``dim_key`` equals ``key``, else ``default``.

    Never multiplies rows: two dimension rows with one key fail the job. ``df`` may be a stream;
    ``dim`` is a table. The dimension's rows and bytes are counted first: within both limits it is
    broadcast and ``df`` is not shuffled. Beyond them the join shuffles, with hot keys of ``df`` taken out (see ``_wide``).
    """
    dim_key, out = dim_key or key, out or value
    entries = dim.select(F.col(dim_key).alias("_key"), F.col(value).alias("_value")).where(
        F.col("_key").isNotNull()
    )
    size = entries.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(sum((_width(entries, c) for c in entries.columns), F.lit(0))), F.lit(0)).alias("bytes"),
    ).first()
    unique = (
        entries.groupBy("_key")
        .agg(F.count("*").alias("_n"), F.any_value("_value").alias("_value"))
        .select(
            "_key",
            F.when(
                F.col("_n") > 1,
                F.raise_error(
                    F.concat(F.lit("duplicate dimension key: "), F.col("_key").cast("string"))
                ).cast(entries.schema["_value"].dataType),
            )
            .otherwise(F.col("_value"))
            .alias("_value"),
        )
    )
    if size["n"] <= max_broadcast_rows and size["bytes"] <= max_broadcast_bytes:
        joined = df.join(F.broadcast(unique), F.col(key) == F.col("_key"), "left")
    elif df.isStreaming:
        joined = df.join(unique, F.col(key) == F.col("_key"), "left")
    else:
        joined = _wide(df, unique, key)
    return joined.select(*df.columns, F.coalesce("_value", F.lit(default)).alias(out))


def _width(df: DataFrame, name: str):
    is_text = isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))
    return F.coalesce(F.octet_length(name), F.lit(0)) + 16 if is_text else F.lit(16)


def _wide(df: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """Left join with a dimension too large to broadcast.

    Keys with more rows than a quarter of a shuffle partition (so fewer than four times as many keys as
    partitions) get their value from a broadcast of just those dimension rows. In the shuffle join their
    rows, and rows with a null key, are spread by a hash of the whole row, which matches nothing; all
    other keys have the salt 0.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bar = max(1, (counts.agg(F.sum("_n")).first()[0] or 0) // (4 * partitions))
    counts = counts.where(F.col(key).isNotNull())
    hot = counts.where(F.col("_n") > bar).select(F.col(key).alias("_hot_key"))
    found = unique.join(F.broadcast(hot), F.col("_key") == F.col("_hot_key"))
    hot_values = hot.join(
        F.broadcast(found.select(F.col("_key"), F.col("_value").alias("_hot_value"))),
        F.col("_hot_key") == F.col("_key"),
        "left",
    ).drop("_key")
    salted = df.join(F.broadcast(hot_values), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_salt",
        F.when(
            F.col("_hot_key").isNotNull() | F.col(key).isNull(),
            F.xxhash64(*df.columns).bitwiseOR(F.lit(1)),
        ).otherwise(F.lit(0).cast("bigint")),
    )
    # Always 0, but not a literal: the optimizer would fold that and leave the salt out of the keys.
    rest = unique.withColumn("_dim_salt", F.pmod(F.xxhash64("_key"), F.lit(1)))
    return (
        salted.join(
            rest.hint("merge"), (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_dim_salt")), "left"
        )
        .withColumn("_value", F.coalesce("_hot_value", "_value"))
    )
