"""The same results from the tables replayed as streams. Each is checked against the batch SQL.

Results that depend on the order of rows get their table in slices of that order, one batch each, so
they hold for any table size and any number of files, and what a batch carries on is read back in the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import sinks, sources
from tallybrook.functions.times import as_wall_clock
from tallybrook.operators import late, lookup, parse, running, tokens, windows
from tallybrook.plans import batch
from tallybrook.plans.batch import DAY, HOUR
from tallybrook.plans.registry import query, table
from tallybrook.session import shared_folder
from tallybrook.sinks import replay_slices
from tallybrook.streaming import carried


def events_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    return sources.table_stream(spark, f"{folder}/events.parquet", "ts", **options)


# --- windows: open ones change from batch to batch, the last change of each counts ----------------


@query(batch.WORD_COUNT_TUMBLING_SQL)
def word_count_tumbling_stream(spark: SparkSession, folder: str) -> DataFrame:
    lines = batch.event_text(events_stream(spark, folder))
    counted = windows.window_count(tokens.tokenize(lines), "ts", HOUR, ["word"], delay_seconds=None)
    rows = sinks.replay_update(counted.select("window_start", "word", "cnt"), ["window_start", "word"])
    return as_wall_clock(rows, "window_start")


@query(batch.SENSOR_MAX_SQL)
def sensor_max_stream(spark: SparkSession, folder: str) -> DataFrame:
    def highest(stream: DataFrame, at: str) -> DataFrame:
        readings = stream.withColumnRenamed("user_id", "id")
        found = windows.window_max(readings, "ts", HOUR, ["id"], "value", delay_seconds=None)
        return sinks.replay_update(found, ["window_start", "window_end", "id"], at)

    rows = replay_slices(table(spark, folder, "events"), "ts", highest, ts="ts")
    return as_wall_clock(as_wall_clock(rows, "window_start"), "window_end")


@query(batch.CATEGORY_TOTAL_SQL)
def category_total_stream(spark: SparkSession, folder: str) -> DataFrame:
    counted = batch.whole_values(events_stream(spark, folder)).withColumnRenamed("event_type", "category")
    totals = windows.window_sum(counted, "ts", HOUR, ["category"], "amount", delay_seconds=None)
    lines = windows.window_line(totals, "category", "category", "total", "total")
    rows = sinks.replay_update(lines, ["window_start", "window_end", "category"])
    return as_wall_clock(as_wall_clock(rows, "window_start"), "window_end")


@query(batch.SALES_SQL)
def sales_per_window_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sales in files of any order: windows stay open, and each batch gives those it changed."""
    lines = sources.table_stream(spark, f"{folder}/lineitem.parquet", "l_shipdate")
    sold = batch.sales(batch.priced(lines, batch.table(spark, folder, "part")), delay_seconds=None)
    rows = sinks.replay_update(sold, ["window_start", "product"])
    return as_wall_clock(rows, "window_start")


def letter_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    return batch.letter_tokens(
        sources.table_stream(spark, f"{folder}/conversations.parquet", **options)
    )


@query(f"SELECT word, count(*) AS n FROM ({batch.LETTER_TOKENS_SQL}) GROUP BY word")
def letter_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The count of every word after the last batch that changed it."""
    counts = letter_stream(spark, folder).groupBy("word").agg(F.count("*").alias("n"))
    return sinks.replay_update(counts, ["word"])


def cards_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    events = events_stream(spark, folder, **options)
    return events.select(
        "event_id", "ts", F.col("user_id").alias("card"), F.col("value").alias("amount")
    )


@query(batch.AMOUNT_COUNT_SQL)
def card_amount_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    counts = running.value_counts(cards_stream(spark, folder), ["card"], "amount")
    return sinks.replay_update(counts, ["card", "amount"])


@query(
    f"""
SELECT card, count(*) AS n, sum(round(amount * 100)::BIGINT)::BIGINT AS total
FROM ({batch.CARDS_SQL}) GROUP BY card
"""
)
def card_latest_total_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Per batch and card one change, combined before the shuffle: the form for hot cards."""
    totals = running.latest_total(batch.in_cents(cards_stream(spark, folder)), ["card"], "cents")
    return sinks.replay_update(totals.select("card", "n", "total"), ["card"])


# --- by slices, with what is carried from batch to batch ----------------------------------------


def letter_changes(spark: SparkSession, folder: str, slices: int, **scan) -> DataFrame:
    """Every change of every word's count."""

    def changes(stream: DataFrame, at: str) -> DataFrame:
        order = ["conv_id", "turn", "position"]
        return carried.running_carried(batch.letter_tokens(stream), ["word"], order, folder=at, **scan)

    return replay_slices(table(spark, folder, "conversations"), "conv_id", changes, slices)


@query(batch.RUNNING_COUNT_LETTER_SQL)
def running_count_letter_stream(spark: SparkSession, folder: str) -> DataFrame:
    return letter_changes(spark, folder, 4)


@query(batch.RUNNING_COUNT_LETTER_SQL)
def running_count_letter_carried(spark: SparkSession, folder: str) -> DataFrame:
    """The same with frequent words split over tasks at any table size."""
    return letter_changes(spark, folder, 5, rows_per_chunk=400)


def card_changes(spark: SparkSession, folder: str, slices: int, **scan) -> DataFrame:
    def changes(stream: DataFrame, at: str) -> DataFrame:
        return carried.running_carried(batch.exact(stream), ["card"], batch.CARD_ORDER, "exact", at, **scan)

    return replay_slices(batch.cards(spark, folder), "ts", changes, slices, ts="ts")


@query(batch.TOTAL_SQL)
def card_running_total_stream(spark: SparkSession, folder: str) -> DataFrame:
    changes = card_changes(spark, folder, 4)
    return changes.select("event_id", "card", F.col("total").cast("double").alias("total"))


@query(batch.TOTAL_SQL)
def card_running_total_carried(spark: SparkSession, folder: str) -> DataFrame:
    """The same with busy cards split over tasks at any table size."""
    changes = card_changes(spark, folder, 5, rows_per_chunk=32)
    return changes.select("event_id", "card", F.col("total").cast("double").alias("total"))


@query(batch.AVERAGE_SQL)
def card_running_avg_stream(spark: SparkSession, folder: str) -> DataFrame:
    changes = card_changes(spark, folder, 4)
    return changes.select("event_id", "card", (F.col("total").cast("double") / F.col("n")).alias("average"))


def card_flags(spark: SparkSession, folder: str, slices: int, **options) -> DataFrame:
    def flags(stream: DataFrame, at: str) -> DataFrame:
        rule = dict(small=1.0, large=100.0, folder=at, **options)
        return carried.flag_small_then_large_carried(stream, ["card"], batch.CARD_ORDER, "amount", **rule)

    flagged = replay_slices(batch.cards(spark, folder), "ts", flags, slices, ts="ts")
    return flagged.where("flagged").select("event_id", "card", "amount")


@query(batch.fraud_sql())
def card_fraud_stream(spark: SparkSession, folder: str) -> DataFrame:
    return card_flags(spark, folder, 4)


@query(batch.fraud_sql("AND epoch_us(ts) - epoch_us(prev_ts) <= 6 * 3600 * 1000000::BIGINT"))
def card_fraud_carried(spark: SparkSession, folder: str) -> DataFrame:
    return card_flags(spark, folder, 5, ts="ts", max_gap_seconds=6 * HOUR)


@query(batch.TOP3_SQL)
def card_top3_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The final top 3, out of the rows that were in it after their batch."""

    def best(stream: DataFrame, at: str) -> DataFrame:
        return carried.top_k_carried(stream, ["card"], batch.CARD_ORDER, "amount", 3, at)

    entered = replay_slices(batch.cards(spark, folder), "ts", best, ts="ts")
    return batch.top3(entered.drop("rank").distinct())


def late_rows_of(spark: SparkSession, folder: str, keys: list[str], slices: int) -> DataFrame:
    def split(stream: DataFrame, at: str) -> DataFrame:
        order = ["arrival", "event_id"]
        return carried.split_late_carried(
            stream, "ts", order, HOUR, delay_seconds=1200, lateness_seconds=600, keys=keys, folder=at
        )

    return replay_slices(batch.arrivals(table(spark, folder, "events")), "arrival", split, slices)


@query(f"SELECT event_id, user_id, value, is_late FROM ({batch.late_sql('user_id')})")
def late_split_stream(spark: SparkSession, folder: str) -> DataFrame:
    return late_rows_of(spark, folder, ["user_id"], 4).select("event_id", "user_id", "value", "is_late")


@query(f"SELECT event_id, user_id, value, is_late FROM ({batch.late_sql()})")
def late_split_carried(spark: SparkSession, folder: str) -> DataFrame:
    """One arrival sequence over the whole stream, which no keyed state could hold at scale."""
    return late_rows_of(spark, folder, [], 5).select("event_id", "user_id", "value", "is_late")


@query(
    f"""
SELECT user_id, window_start, count(*) AS n, sum(value::DECIMAL(18, 2))::DOUBLE AS total
FROM ({batch.late_sql('user_id')}) WHERE NOT is_late GROUP BY ALL
"""
)
def late_windows_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All windows with their rows that were not late."""
    totals = {"n": F.count("*"), "total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}
    rows = late_rows_of(spark, folder, ["user_id"], 4)
    return late.on_time_windows(rows, "ts", HOUR, ["user_id"], totals).drop("window_end")


def fired(spark: SparkSession, folder: str, slices: int, **options) -> DataFrame:
    def trigger(stream: DataFrame, at: str) -> DataFrame:
        events = batch.whole_values(stream)
        return carried.count_trigger_carried(events, "ts", DAY, "amount", 5, ["ts", "event_id"], folder=at, **options)

    return replay_slices(table(spark, folder, "events"), "ts", trigger, slices)


@query(batch.trigger_sql())
def count_trigger_sum_carried(spark: SparkSession, folder: str) -> DataFrame:
    rows = windows.firing_line(fired(spark, folder, 5))
    return rows.select("window_start", "firing", "total", "n", "line")


@query(batch.trigger_sql("event_type"))
def count_trigger_stream_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """A day's state goes once later days have come."""
    rows = windows.firing_line(fired(spark, folder, 4, keys=["event_type"], expire_seconds=DAY))
    return rows.select("window_start", "event_type", "firing", "total", "n", "line")


@query(batch.trigger_sql(remainder=True))
def count_trigger_remainder_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = windows.firing_line(fired(spark, folder, 4, emit_remainder=True))
    return rows.select("window_start", "firing", "total", "n", "line")


ECHO_SQL = """
SELECT 'sum' AS kind, window_start, firing, total, n FROM ({sums})
UNION ALL
SELECT 'input', window_start,
       (row_number() OVER (PARTITION BY window_start ORDER BY ts, event_id) - 1) // 5, amount, 1
FROM (SELECT *, {day} AS window_start, {value}::BIGINT AS amount FROM {events})
"""


@query(ECHO_SQL.format(sums=batch.trigger_sql(), day=batch.EVENT_DAY, value="trunc(value)", events="events"))
def trigger_echo_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Input echo and sums of one counted window sequence, from one query."""
    rows = fired(spark, folder, 4, echo=True)
    return rows.select("kind", "window_start", "firing", "total", "n")


DRAWN_SUMS_SQL = f"""
SELECT * FROM (
  SELECT window_start, firing, sum(v)::BIGINT AS total, count(*) AS n
  FROM (SELECT *, (row_number() OVER (PARTITION BY window_start ORDER BY ts, event_id) - 1) // 5 AS firing
        FROM (SELECT *, {batch.EVENT_DAY} AS window_start FROM ({batch.DRAWN_SQL})))
  GROUP BY ALL) WHERE n = 5
"""


@query(ECHO_SQL.format(sums=DRAWN_SUMS_SQL, day=batch.EVENT_DAY, value="v", events=f"({batch.DRAWN_SQL})"))
def random_trigger_echo_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Random integers counted off in fives, with their echo."""

    def trigger(stream: DataFrame, at: str) -> DataFrame:
        order = ["ts", "event_id"]
        return carried.count_trigger_carried(stream, "ts", DAY, "v", 5, order, echo=True, folder=at)

    rows = replay_slices(batch.drawn(spark, folder), "ts", trigger)
    return rows.withColumn("total", F.col("total").cast("bigint")).select("kind", "window_start", "firing", "total", "n")


# --- text lines ---------------------------------------------------------------------------------

PRICES = {str(k): k / 2 for k in range(1, 40)}
PRICES_SQL = " ".join(f"WHEN {k} THEN {k / 2}" for k in range(1, 40))


@query(
    f"""
SELECT {batch.window_start_sql('l_shipdate', 30 * DAY)} AS window_start, l_partkey::VARCHAR AS product,
       sum(l_quantity::INT * CASE l_partkey {PRICES_SQL} ELSE 1.0 END)::DOUBLE AS sales
FROM lineitem GROUP BY ALL
"""
)
def order_line_sales_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in text files, parsed, priced from a small dimension, and summed in windows."""
    lines = shared_folder(spark, "order-lines")
    sold = table(spark, folder, "lineitem")
    fields = [F.unix_seconds(F.col("l_shipdate").cast("timestamp")), F.col("l_partkey"), F.col("l_quantity").cast("int")]
    sold.select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value")).write.text(lines)
    orders = parse.parse_csv_records(sources.line_stream(spark, lines), "second bigint, product string, qty int")
    priced = lookup.lookup(orders, sources.dimension(spark, PRICES), "product", "price", default=1.0)
    timed = priced.drop("ts").withColumn("ts", F.timestamp_seconds("second"))
    totals = {"sales": F.sum(F.col("qty") * F.col("price"))}
    windowed = windows.window_agg(timed, "ts", 30 * DAY, ["product"], totals, delay_seconds=None).drop("window_end")
    return as_wall_clock(sinks.replay_update(windowed, ["window_start", "product"]), "window_start")


@query("SELECT 'all' AS part, count(*) AS n FROM events UNION ALL SELECT 'small', count(*) FROM events WHERE value < 10")
def fan_out_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Two writers on one stream, each with what it kept."""
    out = shared_folder(spark, "fan-out")

    def keep(part: str, condition: str):
        return lambda rows, number: rows.where(condition).select("event_id").write.mode("overwrite").parquet(f"{out}/{part}/batch={number}")

    stream = sources.table_stream(spark, f"{folder}/events.parquet")
    sinks.fan_out(stream, [keep("all", "true"), keep("small", "value < 10")], f"{out}/checkpoint").awaitTermination()
    counts = [spark.read.parquet(f"{out}/{part}").agg(F.lit(part).alias("part"), F.count("*").alias("n")) for part in ("all", "small")]
    return counts[0].unionAll(counts[1])
