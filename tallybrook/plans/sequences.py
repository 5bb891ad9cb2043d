"""Sessions, revisions of windows, several inputs, and values as of a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import sinks
from tallybrook.functions.times import as_wall_clock
from tallybrook.operators import asof, inputs, revisions, sessions
from tallybrook.plans import batch
from tallybrook.plans.batch import HOUR
from tallybrook.plans.hooks import in_batches
from tallybrook.plans.registry import query, table
from tallybrook.streaming.sessions import session_stream

# --- sessions ---------------------------------------------------------------------------------


def session_values() -> dict[str, tuple[str, Column]]:
    cents = F.round(F.col("value") * 100).cast("bigint")
    return {"n": ("count", F.lit(1)), "cents": ("sum", cents), "largest": ("max", F.col("value"))}


def session_sql(gap: int, keys: str = "") -> str:
    partition, comma = (f"PARTITION BY {keys}", f"{keys}, ") if keys else ("", "")
    gap_sql = f"to_seconds({gap})"
    return f"""
SELECT {comma}min(ts) AS session_start, max(ts) + {gap_sql} AS session_end, count(*) AS n,
       sum(round(value * 100)::BIGINT)::BIGINT AS cents, max(value) AS largest
FROM (SELECT *, sum(opens) OVER ({partition} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER ({partition} ORDER BY ts, event_id) + {gap_sql} THEN 0 ELSE 1 END AS opens
            FROM events))
GROUP BY {comma}session
"""


def user_sessions_of(spark: SparkSession, folder: str, keys: list[str], gap: int, **scan) -> DataFrame:
    return sessions.sessions(table(spark, folder, "events"), "ts", gap, keys, session_values(), **scan)


@query(session_sql(6 * HOUR, "user_id"))
def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return user_sessions_of(spark, folder, ["user_id"], 6 * HOUR)


@query(session_sql(6 * HOUR, "user_id"))
def user_sessions_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with busy users split over tasks at any table size."""
    return user_sessions_of(spark, folder, ["user_id"], 6 * HOUR, rows_per_chunk=32)


@query(session_sql(300))
def all_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of the whole table, a single sequence."""
    return user_sessions_of(spark, folder, [], 300, rows_per_chunk=8192)


@query(session_sql(6 * HOUR, "user_id"))
def user_sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in four batches of any order: later ones join what were sessions of their own."""
    stream = in_batches(table(spark, folder, "events").select("ts", "user_id", "value"), "ts")
    changes = session_stream(stream, "ts", 6 * HOUR, ["user_id"], session_values())
    last = sinks.replay_update(changes, ["user_id", "session_start"]).where("NOT merged").drop("merged")
    return as_wall_clock(as_wall_clock(last, "session_start"), "session_end")


# --- revisions ----------------------------------------------------------------------------------

DELAY, LATENESS = 600, 2400

REVISIONS_SQL = f"""
WITH marked AS (
  SELECT *, window_start + INTERVAL 1 HOUR + to_seconds({DELAY}) AS closing,
         coalesce(prior_max_ts >= window_start + INTERVAL 1 HOUR + to_seconds({DELAY}), false) AS after
  FROM (SELECT l.*, a.arrival FROM ({batch.late_sql("", DELAY, LATENESS)}) l JOIN ({batch.ARRIVALS_SQL}) a USING (event_id))
), first AS (
  SELECT window_start, closing, count(*) AS n, sum(value::DECIMAL(18, 2)) AS total FROM marked WHERE NOT after GROUP BY ALL
), closed AS (
  SELECT f.window_start, f.n, f.total, min({{'arrival': m.arrival, 'event_id': m.event_id}}) AS by_row
  FROM first f JOIN marked m ON m.ts >= f.closing GROUP BY ALL
), later AS (
  SELECT window_start, event_id,
         count(*) OVER w AS rn, sum(value::DECIMAL(18, 2)) OVER w AS total
  FROM marked WHERE after AND NOT is_late
  WINDOW w AS (PARTITION BY window_start ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING)
)
SELECT window_start, 0 AS revision, n, total::DOUBLE AS total, by_row.event_id AS event_id FROM closed
UNION ALL
SELECT l.window_start, l.rn - CASE WHEN f.n IS NULL THEN 1 ELSE 0 END, coalesce(f.n, 0) + l.rn,
       (coalesce(f.total, 0) + l.total)::DOUBLE, l.event_id
FROM later l LEFT JOIN first f USING (window_start)
"""


def revised(spark: SparkSession, folder: str, **scan) -> DataFrame:
    rows = revisions.window_revisions(
        batch.arrivals(table(spark, folder, "events")),
        "ts",
        ["arrival", "event_id"],
        HOUR,
        F.col("value").cast("decimal(18,2)"),
        delay_seconds=DELAY,
        lateness_seconds=LATENESS,
        **scan,
    )
    return rows.select("window_start", "revision", "n", F.col("total").cast("double").alias("total"), "event_id")


@query(REVISIONS_SQL)
def window_revision_log(spark: SparkSession, folder: str) -> DataFrame:
    """Each result of each hour: at its closing, and for each row accepted in the 40 minutes after."""
    return revised(spark, folder)


@query(REVISIONS_SQL)
def window_revision_log_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the sequence, and large windows, split over tasks at any table size."""
    return revised(spark, folder, rows_per_chunk=500)


# --- several inputs -------------------------------------------------------------------------------

IDLE = 6 * HOUR
INPUT_SQL = "CASE WHEN event_id % 10 = 3 AND epoch_us(ts) < epoch_us(TIMESTAMP '2024-01-11') THEN 2 ELSE event_id % 2 END"


def of_input(j: int, column: str) -> str:
    return f"max({column}) FILTER (WHERE input = {j}) OVER w"


INPUTS_SQL = f"""
SELECT event_id, input, common_ts,
       coalesce(common_ts >= window_start + INTERVAL 1 HOUR + to_seconds(1800), false) AS is_late
FROM (SELECT *, max(CASE WHEN NOT waits THEN least(t0, t1, t2) END) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS common_ts
  FROM (SELECT *, (a0 AND m0 IS NULL) OR (a1 AND m1 IS NULL) OR (a2 AND m2 IS NULL) AS waits,
               CASE WHEN a0 THEN m0 END AS t0, CASE WHEN a1 THEN m1 END AS t1, CASE WHEN a2 THEN m2 END AS t2
    FROM (SELECT *, {", ".join(f"coalesce(coalesce(l{j}, first) + to_seconds({IDLE}) >= arrival, false) AS a{j}" for j in range(3))}
      FROM (SELECT *, {", ".join(f"{of_input(j, 'ts')} AS m{j}, {of_input(j, 'arrival')} AS l{j}" for j in range(3))},
                   min(arrival) OVER w AS first
        FROM (SELECT *, {batch.EVENT_HOUR} AS window_start, ({INPUT_SQL})::INT AS input FROM ({batch.ARRIVALS_SQL}))
        WINDOW w AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))))
"""


@query(INPUTS_SQL)
def late_split_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows by the common time of three inputs, one of which falls silent after ten days."""
    arrived = batch.arrivals(table(spark, folder, "events"))
    third = (F.col("event_id") % 10 == 3) & (F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    given = arrived.withColumn("input", F.when(third, 2).otherwise((F.col("event_id") % 2).cast("int")))
    split = inputs.split_late_inputs(
        given, "ts", "arrival", ["arrival", "event_id"], "input", [0, 1, 2], HOUR, idle_seconds=IDLE, delay_seconds=1200, lateness_seconds=600
    )
    return split.select("event_id", "input", "common_ts", "is_late")


# --- as of ---------------------------------------------------------------------------------------

ASOF_SQL = """
SELECT e.event_id, coalesce(c.value, 1.0) AS valid
FROM (SELECT * FROM events WHERE event_type <> 'view') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c ON e.user_id = c.user_id AND e.ts >= c.ts
"""


def valid_values(spark: SparkSession, folder: str, **scan) -> DataFrame:
    events = table(spark, folder, "events")
    asked = events.where("event_type <> 'view'").select("event_id", "ts", "user_id")
    told = events.where("event_type = 'view'").select("event_id", "ts", "user_id", "value")
    found = asof.as_of(asked, "ts", "event_id", told, "ts", "event_id", ["user_id"], "value", default=1.0, out="valid", **scan)
    return found.select("event_id", "valid")


@query(ASOF_SQL)
def as_of_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """For each event the value of the user's last view, 1.0 before the first."""
    return valid_values(spark, folder)


@query(ASOF_SQL)
def as_of_lookup_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with busy users split over tasks at any table size."""
    return valid_values(spark, folder, rows_per_chunk=32)
