"""User code in streams and windows, and printed streams. Each is checked against SQL over the same table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallybrook import sinks, sources
from tallybrook.functions.times import as_wall_clock, epoch_micros
from tallybrook.operators import fold, windows
from tallybrook.plans import batch
from tallybrook.plans.batch import DAY, HOUR
from tallybrook.plans.registry import query, table
from tallybrook.session import shared_folder
from tallybrook.streaming import folds


def in_batches(df: DataFrame, ts: str | None = None, batches: int = 4) -> DataFrame:
    """A table as a stream of that many batches, rows in any order."""
    folder = shared_folder(df.sparkSession, "batches")
    df.repartition(batches).write.parquet(folder)
    return sources.table_stream(df.sparkSession, folder, ts, maxFilesPerTrigger=1)


AMOUNTS = dict(
    add=batch.add_amounts,
    merge=batch.merge_amounts,
    result=batch.finish_amounts,
    accumulator="n bigint, cents bigint, largest bigint",
    output="n bigint, total double, largest double",
)


@query(batch.USER_FOLD_SQL)
def user_fold_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The user's count, sum and maximum per card, kept in state over four batches."""
    stream = in_batches(batch.in_cents(batch.cards(spark, folder)).select("card", "cents"))
    return sinks.replay_update(folds.fold_stream(stream, ["card"], **AMOUNTS), ["card"])


def in_windows(code):
    """The user's code for cards, by window too."""
    keys = ["window_start", "window_end", "card"]

    def add(rows):
        return rows.groupby(keys, dropna=False)["cents"].agg(n="size", cents="sum", largest="max").reset_index()

    def merge(parts):
        return parts.groupby(keys, dropna=False).agg({"n": "sum", "cents": "sum", "largest": "max"}).reset_index()

    return {**code, "add": add, "merge": merge}


@query(
    f"""
SELECT window_start, card, count(*) AS n, sum(amount::DECIMAL(18, 2))::DOUBLE AS total,
       max(amount::DECIMAL(18, 2))::DOUBLE AS largest
FROM (SELECT *, {batch.EVENT_DAY} AS window_start FROM ({batch.CARDS_SQL})) GROUP BY ALL
"""
)
def user_fold_windows_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same per day."""
    stream = in_batches(batch.in_cents(batch.cards(spark, folder)).select("ts", "card", "cents"), "ts")
    folded = folds.fold_windows_stream(stream, "ts", DAY, ["card"], **in_windows(AMOUNTS))
    rows = sinks.replay_update(folded, ["window_start", "window_end", "card"])
    return as_wall_clock(rows, "window_start").drop("window_end")


class LongestGap(fold.WindowProcess):
    """How many rows a window has, its longest pause and the row that ended it (the first of equals)."""

    def __init__(self):
        self.n, self.before, self.longest, self.ended = 0, None, None, None

    def row(self, row: Row) -> Iterable[tuple]:
        self.n += 1
        if self.before is not None and (self.longest is None or row["us"] - self.before > self.longest):
            self.longest, self.ended = row["us"] - self.before, row["event_id"]
        self.before = row["us"]
        return ()

    def end(self) -> Iterable[tuple]:
        yield self.n, self.longest, self.ended


@query(
    f"""
SELECT window_start, event_type, n, gap AS longest, CASE WHEN gap IS NOT NULL THEN event_id END AS ended_by
FROM (SELECT *, count(*) OVER (PARTITION BY window_start, event_type) AS n,
             row_number() OVER (PARTITION BY window_start, event_type ORDER BY gap DESC NULLS LAST, ts, event_id) AS place
      FROM (SELECT event_id, ts, window_start, event_type,
                   epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY window_start, event_type ORDER BY ts, event_id) AS gap
            FROM (SELECT *, {batch.EVENT_DAY} AS window_start FROM events)))
WHERE place = 1
"""
)
def window_longest_gap(spark: SparkSession, folder: str) -> DataFrame:
    """A user's function of the rows of each window, given one by one."""
    events = table(spark, folder, "events")
    timed = events.select("ts", "event_id", "event_type", epoch_micros(events, "ts").alias("us"))
    output = "n bigint, longest bigint, ended_by bigint"
    return fold.process_windows(timed, "ts", DAY, ["event_type"], ["ts", "event_id"], LongestGap, output).drop("window_end")


class Rises(fold.WindowProcess):
    """Each row that is larger than all before it in its window."""

    def __init__(self):
        self.largest = None

    def row(self, row: Row) -> Iterable[tuple]:
        if self.largest is None or row["value"] > self.largest:
            self.largest = row["value"]
            yield row["event_id"], row["value"]


@query(
    f"""
SELECT window_start, event_type, event_id, value
FROM (SELECT *, max(value) OVER (PARTITION BY window_start, event_type ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM (SELECT *, {batch.EVENT_HOUR} AS window_start FROM events))
WHERE before IS NULL OR value > before
"""
)
def window_records(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that a user's function gives while it reads a window."""
    timed = table(spark, folder, "events").select("ts", "event_id", "event_type", "value")
    found = fold.process_windows(timed, "ts", HOUR, ["event_type"], ["ts", "event_id"], Rises, "event_id bigint, value double")
    return found.drop("window_end")


@query("SELECT 'Input Data> ' || trunc(value)::INT AS line, count(*) AS n FROM events GROUP BY ALL")
def printed_echo_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Echo lines of a stream of four batches, printed by its tasks and read again."""
    out = shared_folder(spark, "printed")
    lines = windows.input_line(batch.whole_values(in_batches(table(spark, folder, "events"))), "amount").select("line")
    sinks.print_stream(lines, f"{out}/_checkpoint", out, availableNow=True).awaitTermination()
    return sinks.printed_lines(spark, out).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))
