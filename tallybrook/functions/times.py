"""Time columns. Every helper gives the same result whatever the session time zone is.

``TIMESTAMP_NTZ`` columns are read as UTC wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch."""
    if is_ntz(df, name):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(name)


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since the epoch, rounded down."""
    micros = epoch_micros(df, name)
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))


def as_instant(df: DataFrame, name: str) -> DataFrame:
    """Turn an NTZ column into a ``TIMESTAMP``: stream watermarks reject NTZ."""
    return df.withColumn(name, F.timestamp_micros(epoch_micros(df, name))) if is_ntz(df, name) else df


def as_wall_clock(df: DataFrame, name: str) -> DataFrame:
    """Turn a ``TIMESTAMP`` column back into UTC wall-clock ``TIMESTAMP_NTZ``."""
    if is_ntz(df, name):
        return df
    return df.withColumn(
        name,
        F.expr(
            f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + unix_micros(`{name}`) * INTERVAL '0.000001' SECOND"
        ),
    )


def seconds_interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def timestamps_as_micros(df: DataFrame) -> DataFrame:
    """Times as whole microseconds: Python would shift them through its own time zone."""
    return df.withColumns({c: F.unix_micros(c) for c, t in df.dtypes if t == "timestamp"})


def micros_as_timestamps(df: DataFrame, like: DataFrame) -> DataFrame:
    times = [c for c, t in like.dtypes if t == "timestamp" and c in df.columns]
    return df.withColumns({c: F.timestamp_micros(c) for c in times})
