"""Queries over the tables at rest."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import sinks, sources
from tallybrook.functions.times import epoch_micros
from tallybrook.operators import count_trigger, fold, late, lookup, parse, running, tokens, windows
from tallybrook.plans.registry import query, table, window_start_sql
from tallybrook.session import shared_folder

HOUR, DAY = 3600, 86_400
EVENT_HOUR = window_start_sql("ts", HOUR)
EVENT_DAY = window_start_sql("ts", DAY)

# --- text -------------------------------------------------------------------------------------

WORD_COUNT_SQL = r"""
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
"""


@query(WORD_COUNT_SQL)
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.word_count(table(spark, folder, "documents"), "text")


@query(WORD_COUNT_SQL)
def word_count_files(spark: SparkSession, folder: str) -> DataFrame:
    """Word count from text files to delimited files."""
    lines, out = shared_folder(spark, "lines"), shared_folder(spark, "counts")
    table(spark, folder, "documents").select("text").write.text(lines)
    sinks.write_delimited(tokens.word_count(sources.text_lines(spark, lines)), out)
    return spark.read.schema("word string, cnt bigint").option("sep", " ").csv(out)


def event_text(events: DataFrame) -> DataFrame:
    return events.select("ts", F.concat_ws(" ", "event_type", "props").alias("value"))


WORD_COUNT_TUMBLING_SQL = rf"""
SELECT window_start, word, count(*) AS cnt
FROM (SELECT {EVENT_HOUR} AS window_start,
             unnest(regexp_split_to_array(lower(event_type || ' ' || props), '\W+')) AS word
      FROM events)
WHERE word <> '' GROUP BY ALL
"""


@query(WORD_COUNT_TUMBLING_SQL)
def word_count_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    lines = event_text(table(spark, folder, "events"))
    counted = windows.window_count(tokens.tokenize(lines), "ts", HOUR, ["word"])
    return counted.select("window_start", "word", "cnt")


LETTER_TOKENS_SQL = r"""
SELECT * FROM (
  SELECT conv_id, turn, unnest(pieces) AS word,
         (generate_subscripts(pieces, 1) - 1)::INT AS position
  FROM (SELECT conv_id, turn, regexp_split_to_array(lower(text), '\W+') AS pieces FROM conversations)
) WHERE word <> '' AND contains(word, 'a')
"""


def letter_tokens(conversations: DataFrame) -> DataFrame:
    """Words with an ``a``, whatever its case in the text, with their place."""
    lines = conversations.select("conv_id", "turn", "text")
    return tokens.containing(tokens.tokenize(lines, "text", position="position"), "word", "a")


@query(f"SELECT conv_id, turn, position, word FROM ({LETTER_TOKENS_SQL})")
def letter_words(spark: SparkSession, folder: str) -> DataFrame:
    return letter_tokens(table(spark, folder, "conversations"))


RUNNING_COUNT_LETTER_SQL = f"""
SELECT conv_id, turn, position, word,
       count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, position
                      ROWS UNBOUNDED PRECEDING) AS n
FROM ({LETTER_TOKENS_SQL})
"""


@query(RUNNING_COUNT_LETTER_SQL)
def running_count_letter(spark: SparkSession, folder: str) -> DataFrame:
    found = letter_tokens(table(spark, folder, "conversations"))
    return running.running_count(found, ["word"], ["conv_id", "turn", "position"])


@query(RUNNING_COUNT_LETTER_SQL)
def running_count_letter_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with frequent words split over tasks at any table size."""
    found = letter_tokens(table(spark, folder, "conversations"))
    return running.running_count(
        found, ["word"], ["conv_id", "turn", "position"], rows_per_chunk=400
    )


# --- parsing ----------------------------------------------------------------------------------

# Every tenth line each: a bad number, a missing field, a blank line, a surplus field and padding.
PAIR_LINES = """
CASE event_id % 10 WHEN 1 THEN user_id || ' x' || value WHEN 3 THEN '' || user_id WHEN 5 THEN '  '
     WHEN 7 THEN user_id || '  ' || value || ' more' WHEN 9 THEN ' ' || user_id || ' ' || value || '  '
     ELSE user_id || ' ' || value END
"""
CSV_LINES = """
CASE event_id % 10 WHEN 1 THEN event_id || ',' || event_type WHEN 2 THEN event_id || ',' || event_type || ',1.5'
     WHEN 3 THEN event_id || ',' || event_type || ',' || user_id || ',x' WHEN 5 THEN ''
     WHEN 7 THEN event_id || ', ' || event_type || ' , ' || user_id || ' ,,'
     ELSE event_id || ',' || event_type || ',' || user_id END
"""

PARSE_PAIRS_SQL = rf"""
SELECT event_id,
       CASE WHEN reason IS NULL THEN parts[1] END AS id,
       CASE WHEN reason IS NULL THEN TRY_CAST(parts[2] AS DOUBLE) END AS reading,
       CASE WHEN reason IS NOT NULL THEN trim(line) END AS bad_line,
       reason AS bad_reason
FROM (SELECT *, CASE WHEN len(parts) < 2 THEN 'arity'
                     WHEN TRY_CAST(parts[2] AS DOUBLE) IS NULL THEN 'value' END AS reason
      FROM (SELECT event_id, line, regexp_split_to_array(trim(line), '\s+') AS parts
            FROM (SELECT event_id, {PAIR_LINES} AS line FROM events)
            WHERE trim(line) <> ''))
"""


@query(PARSE_PAIRS_SQL)
def parse_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "events").select("event_id", F.expr(PAIR_LINES).alias("value"))
    return parse.parse_pairs(
        lines, "id string, reading double", on_arity="quarantine", on_bad="quarantine"
    )


CSV_PARTS_SQL = rf"""
SELECT event_id, parts, len(parts) AS n FROM (
  SELECT event_id, string_split(rtrim(trim(line), ','), ',') AS parts
  FROM (SELECT event_id, {CSV_LINES} AS line FROM events) WHERE trim(line) <> '')
"""


def csv_lines(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.expr(CSV_LINES).alias("value"))


@query(
    f"""
SELECT event_id, trim(parts[1]) AS order_id, trim(parts[2]) AS product, qty
FROM (SELECT *, TRY_CAST(CASE WHEN trim(parts[3]) NOT LIKE '%.%' THEN trim(parts[3]) END AS INT) AS qty
      FROM ({CSV_PARTS_SQL}) WHERE n = 3) WHERE qty IS NOT NULL
"""
)
def parse_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Exactly three fields; other counts and bad numbers dropped."""
    return parse.parse_csv_records(
        csv_lines(table(spark, folder, "events")),
        "order_id string, product string, qty int",
        on_bad="drop",
    )


@query(f"SELECT event_id, trim(parts[1])::BIGINT AS id, trim(parts[2]) AS kind FROM ({CSV_PARTS_SQL}) WHERE n >= 2")
def parse_csv_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """At least two fields, the rest ignored; a bad number would fail the job."""
    return parse.parse_csv_records(
        csv_lines(table(spark, folder, "events")), "id bigint, kind string", exact=False
    )


# --- lookup -----------------------------------------------------------------------------------


def priced(lines: DataFrame, parts: DataFrame, **limits) -> DataFrame:
    """Order lines with the price of their part, 1.0 for parts that have none, and their value."""
    with_price = lookup.lookup(
        lines.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity"),
        parts,
        "l_partkey",
        "p_retailprice",
        dim_key="p_partkey",
        default=1.0,
        out="price",
        **limits,
    )
    return with_price.withColumn("subtotal", F.col("l_quantity") * F.col("price"))


def priced_lines(spark: SparkSession, folder: str, **limits) -> DataFrame:
    return priced(table(spark, folder, "lineitem"), table(spark, folder, "part"), **limits)


PRICED_SQL = """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, coalesce(p_retailprice, 1.0) AS price,
       l_quantity * coalesce(p_retailprice, 1.0) AS subtotal
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""
LOOKUP_SQL = f"SELECT l_orderkey, l_linenumber, l_partkey, price, subtotal FROM ({PRICED_SQL})"


@query(LOOKUP_SQL)
def dimension_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return priced_lines(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "price", "subtotal"
    )


@query(LOOKUP_SQL)
def dimension_lookup_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when the dimension is too large to broadcast."""
    return priced_lines(spark, folder, max_broadcast_rows=0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "price", "subtotal"
    )


@query("SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def label_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The rating of each document, -1 for those without one."""
    docs = table(spark, folder, "documents").select("doc_id")
    return lookup.lookup(docs, table(spark, folder, "labels"), "doc_id", "quality", default=-1)


# --- windowed aggregates ----------------------------------------------------------------------


SALES_SQL = f"""
SELECT {window_start_sql('l_shipdate', 30 * DAY)} AS window_start, l_partkey AS product,
       sum(subtotal::DECIMAL(18, 2))::DOUBLE AS sales
FROM ({PRICED_SQL}) GROUP BY ALL
"""


def sales(lines: DataFrame, **options) -> DataFrame:
    # Whole cents add up exactly in any order, and faster than decimals.
    totals = {"sales": F.sum(F.round(F.col("subtotal") * 100).cast("bigint")) / 100}
    products = lines.withColumnRenamed("l_partkey", "product")
    return windows.window_agg(
        products, "l_shipdate", 30 * DAY, ["product"], totals, **options
    ).drop("window_end")


@query(SALES_SQL)
def sales_per_window(spark: SparkSession, folder: str) -> DataFrame:
    return sales(priced_lines(spark, folder))


SENSOR_MAX_SQL = f"""
SELECT {EVENT_HOUR} AS window_start, {EVENT_HOUR} + INTERVAL 1 HOUR AS window_end,
       user_id AS id, max(value) AS max
FROM events GROUP BY ALL
"""


@query(SENSOR_MAX_SQL)
def sensor_max(spark: SparkSession, folder: str) -> DataFrame:
    readings = table(spark, folder, "events").withColumnRenamed("user_id", "id")
    return windows.window_max(readings, "ts", HOUR, ["id"], "value")


def whole_values(events: DataFrame) -> DataFrame:
    return events.withColumn("amount", F.col("value").cast("int"))


CATEGORY_TOTAL_SQL = f"""
SELECT *, printf('category=%s window=[%d,%d) total=%d', category, epoch_us(window_start) // 1000,
                 epoch_us(window_end) // 1000, total) AS line
FROM (SELECT {EVENT_HOUR} AS window_start, {EVENT_HOUR} + INTERVAL 1 HOUR AS window_end,
             event_type AS category, sum(trunc(value)::INT)::BIGINT AS total
      FROM events GROUP BY ALL)
"""


@query(CATEGORY_TOTAL_SQL)
def category_total_window(spark: SparkSession, folder: str) -> DataFrame:
    counted = whole_values(table(spark, folder, "events")).withColumnRenamed("event_type", "category")
    totals = windows.window_sum(counted, "ts", HOUR, ["category"], "amount")
    return windows.window_line(totals, "category", "category", "total", "total")


@query(
    f"""
SELECT *, printf('sensor=%s window=[%d,%d) max=%d', id::VARCHAR, epoch_us(window_start) // 1000,
                 epoch_us(window_end) // 1000, max) AS line
FROM (SELECT {EVENT_HOUR} AS window_start, {EVENT_HOUR} + INTERVAL 1 HOUR AS window_end,
             user_id AS id, max(trunc(value)::INT) AS max
      FROM events GROUP BY ALL)
"""
)
def level_max_window(spark: SparkSession, folder: str) -> DataFrame:
    levels = whole_values(table(spark, folder, "events")).withColumnRenamed("user_id", "id")
    highest = windows.window_max(levels, "ts", HOUR, ["id"], "amount")
    return windows.window_line(highest, "id", "sensor", "max", "max")


@query("SELECT event_id, 'Input Data> ' || trunc(value)::INT AS line FROM events")
def input_echo(spark: SparkSession, folder: str) -> DataFrame:
    return windows.input_line(whole_values(table(spark, folder, "events")), "amount").select(
        "event_id", "line"
    )


# --- counted windows --------------------------------------------------------------------------


def trigger_sql(keys: str = "", remainder: bool = False) -> str:
    comma = f"{keys}, " if keys else ""
    return f"""
SELECT *, 'Sum of window> ' || total || ' (count=' || n || ')' AS line
FROM (SELECT window_start, {comma}firing, sum(amount)::BIGINT AS total, count(*) AS n
      FROM (SELECT *, (row_number() OVER (PARTITION BY {comma}window_start ORDER BY ts, event_id) - 1) // 5
                      AS firing
            FROM (SELECT *, {EVENT_DAY} AS window_start, trunc(value)::INT AS amount FROM events))
      GROUP BY ALL)
{'' if remainder else 'WHERE n = 5'}
"""


def counted(spark: SparkSession, folder: str, **options) -> DataFrame:
    events = whole_values(table(spark, folder, "events"))
    sums = count_trigger.count_trigger_sums(
        events, "ts", DAY, "amount", 5, ["ts", "event_id"], **options
    )
    return windows.firing_line(sums).drop("window_end")


@query(trigger_sql())
def count_trigger_sum(spark: SparkSession, folder: str) -> DataFrame:
    return counted(spark, folder)


@query(trigger_sql())
def count_trigger_sum_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with large windows split over tasks at any table size."""
    return counted(spark, folder, rows_per_chunk=100)


@query(trigger_sql("event_type"))
def count_trigger_sum_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return counted(spark, folder, keys=["event_type"])


@query(trigger_sql(remainder=True))
def count_trigger_remainder(spark: SparkSession, folder: str) -> DataFrame:
    return counted(spark, folder, emit_remainder=True)


# --- late rows --------------------------------------------------------------------------------

ARRIVALS_SQL = "SELECT *, ts + to_seconds((event_id * 7919) % 7200) AS arrival FROM events"


def late_sql(keys: str = "", delay: int = 1200, lateness: int = 600) -> str:
    partition = f"PARTITION BY {keys}" if keys else ""
    return f"""
SELECT event_id, user_id, ts, value, prior_max_ts, window_start,
       coalesce(prior_max_ts >= window_start + INTERVAL 1 HOUR + to_seconds({delay + lateness}), false)
       AS is_late
FROM (SELECT *, {EVENT_HOUR} AS window_start,
             max(ts) OVER ({partition} ORDER BY arrival, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max_ts
      FROM ({ARRIVALS_SQL}))
"""


def arrivals(events: DataFrame) -> DataFrame:
    """Events with a made-up arrival time up to two hours after their own time."""
    after = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.pmod(F.col("event_id") * 7919, F.lit(7200)).cast("decimal(18,6)")
    )
    return events.select("event_id", "user_id", "ts", "value", (F.col("ts") + after).alias("arrival"))


def split(spark: SparkSession, folder: str, **options) -> DataFrame:
    return late.split_late(
        arrivals(table(spark, folder, "events")),
        "ts",
        ["arrival", "event_id"],
        HOUR,
        delay_seconds=1200,
        lateness_seconds=600,
        **options,
    )


@query(late_sql())
def late_split(spark: SparkSession, folder: str) -> DataFrame:
    return split(spark, folder).drop("arrival", "window_end")


@query(late_sql())
def late_split_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the one arrival sequence split over tasks at any table size."""
    return split(spark, folder, rows_per_chunk=1000).drop("arrival", "window_end")


@query(late_sql("user_id"))
def late_split_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return split(spark, folder, keys=["user_id"]).drop("arrival", "window_end")


@query(f"SELECT event_id, ts, window_start, prior_max_ts FROM ({late_sql()}) WHERE is_late")
def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    return late.late(split(spark, folder)).select("event_id", "ts", "window_start", "prior_max_ts")


@query(
    f"""
SELECT window_start, count(*) AS n, sum(value::DECIMAL(18, 2))::DOUBLE AS total
FROM ({late_sql()}) WHERE NOT is_late GROUP BY ALL
"""
)
def late_window_sum(spark: SparkSession, folder: str) -> DataFrame:
    totals = {"n": F.count("*"), "total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}
    return late.on_time_windows(split(spark, folder), "ts", HOUR, [], totals).drop("window_end")


@query(
    f"""
SELECT event_id, epoch_us(prior_max_ts) // 1000 - 1200 * 1000 - 1 AS watermark_ms FROM ({late_sql()})
"""
)
def watermark_trace(spark: SparkSession, folder: str) -> DataFrame:
    return late.watermark_trace(
        arrivals(table(spark, folder, "events")), "ts", ["arrival", "event_id"], delay_seconds=1200
    ).select("event_id", "watermark_ms")


# --- cards ------------------------------------------------------------------------------------

CARD_ORDER = ["ts", "event_id"]
CARDS_SQL = "SELECT event_id, ts, user_id AS card, value AS amount FROM events"
CARD_RUN = "OVER (PARTITION BY card ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def cards(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("card"), F.col("value").alias("amount")
    )


def exact(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("exact", F.col("amount").cast("decimal(18,2)"))


def fraud_sql(gap: str = "") -> str:
    return f"""
SELECT event_id, card, amount
FROM (SELECT *, lag(amount) OVER w AS prev, lag(ts) OVER w AS prev_ts FROM ({CARDS_SQL})
      WINDOW w AS (PARTITION BY card ORDER BY ts, event_id))
WHERE amount > 100 AND prev < 1 {gap}
"""


@query(fraud_sql())
def card_fraud(spark: SparkSession, folder: str) -> DataFrame:
    flagged = running.flag_small_then_large(
        cards(spark, folder), ["card"], CARD_ORDER, "amount", small=1.0, large=100.0
    )
    return flagged.where("flagged").select("event_id", "card", "amount")


@query(fraud_sql("AND epoch_us(ts) - epoch_us(prev_ts) <= 6 * 3600 * 1000000::BIGINT"))
def card_fraud_within(spark: SparkSession, folder: str) -> DataFrame:
    """The small amount at most six hours before, and busy cards split over tasks."""
    flagged = running.flag_small_then_large(
        cards(spark, folder),
        ["card"],
        CARD_ORDER,
        "amount",
        small=1.0,
        large=100.0,
        ts="ts",
        max_gap_seconds=6 * HOUR,
        rows_per_chunk=32,
    )
    return flagged.where("flagged").select("event_id", "card", "amount")


TOTAL_SQL = f"""
SELECT event_id, card, (sum(amount::DECIMAL(18, 2)) {CARD_RUN})::DOUBLE AS total FROM ({CARDS_SQL})
"""


@query(TOTAL_SQL)
def card_running_total(spark: SparkSession, folder: str) -> DataFrame:
    totals = running.running_total(exact(cards(spark, folder)), ["card"], CARD_ORDER, "exact")
    return totals.select("event_id", "card", F.col("total").cast("double").alias("total"))


@query(TOTAL_SQL)
def card_running_total_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same with busy cards split over tasks at any table size."""
    totals = running.running_total(
        exact(cards(spark, folder)), ["card"], CARD_ORDER, "exact", rows_per_chunk=32
    )
    return totals.select("event_id", "card", F.col("total").cast("double").alias("total"))


AVERAGE_SQL = f"""
SELECT event_id, card,
       (sum(amount::DECIMAL(18, 2)) {CARD_RUN})::DOUBLE / (count(*) {CARD_RUN}) AS average
FROM ({CARDS_SQL})
"""


@query(AVERAGE_SQL)
def card_running_avg(spark: SparkSession, folder: str) -> DataFrame:
    averages = running.running_avg(exact(cards(spark, folder)), ["card"], CARD_ORDER, "exact")
    return averages.select("event_id", "card", "average")


TOP3_SQL = f"""
SELECT card, event_id, amount, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY card ORDER BY amount DESC, ts, event_id) AS rank
      FROM ({CARDS_SQL})) WHERE rank <= 3
"""


def top3(transactions: DataFrame) -> DataFrame:
    best = [F.col("amount").desc(), F.col("ts"), F.col("event_id")]
    return running.top_k(transactions, ["card"], best, 3).select("card", "event_id", "amount", "rank")


@query(TOP3_SQL)
def card_top3(spark: SparkSession, folder: str) -> DataFrame:
    return top3(cards(spark, folder))


AMOUNT_COUNT_SQL = f"SELECT card, amount, count(*) AS n FROM ({CARDS_SQL}) GROUP BY ALL"


@query(AMOUNT_COUNT_SQL)
def card_amount_count(spark: SparkSession, folder: str) -> DataFrame:
    return running.value_counts(cards(spark, folder), ["card"], "amount")


# --- random integers and user code --------------------------------------------------------------


def drawn(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(
        "event_id", "ts", sources.random_int(F.col("event_id"), 1, 10, seed=7).alias("v")
    )


DRAWN_SQL = """
SELECT event_id, ts, (1 + ('0x' || substr(md5(event_id || '|7'), 1, 8))::BIGINT % 10)::INT AS v FROM events
"""


@query(f"SELECT event_id, v FROM ({DRAWN_SQL})")
def random_ints(spark: SparkSession, folder: str) -> DataFrame:
    """One draw of 1..10 per event."""
    return drawn(spark, folder).select("event_id", "v")


@query("SELECT count(*) AS n, 1 AS lowest, 10 AS highest, 10::BIGINT AS n_values FROM events")
def random_ints_range(spark: SparkSession, folder: str) -> DataFrame:
    """Both bounds are reached and nothing lies outside."""
    return drawn(spark, folder).agg(
        F.count("*").alias("n"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.count_distinct("v").alias("n_values"),
    )


def add_amounts(rows: pd.DataFrame) -> pd.DataFrame:
    grouped = rows.groupby("card", dropna=False)["cents"]
    return grouped.agg(n="size", cents="sum", largest="max").reset_index()


def merge_amounts(parts: pd.DataFrame) -> pd.DataFrame:
    grouped = parts.groupby("card", dropna=False)
    return grouped.agg({"n": "sum", "cents": "sum", "largest": "max"}).reset_index()


def finish_amounts(parts: pd.DataFrame) -> pd.DataFrame:
    return parts.assign(total=parts["cents"] / 100.0, largest=parts["largest"] / 100.0)


def in_cents(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("cents", F.round(F.col("amount") * 100).cast("bigint"))


USER_FOLD_SQL = f"""
SELECT card, count(*) AS n, sum(amount::DECIMAL(18, 2))::DOUBLE AS total,
       max(amount::DECIMAL(18, 2))::DOUBLE AS largest
FROM ({CARDS_SQL}) GROUP BY card
"""


@query(USER_FOLD_SQL)
def user_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Count, sum and maximum per card in user code."""
    return fold.fold_agg(
        in_cents(cards(spark, folder)).select("card", "cents"),
        ["card"],
        add=add_amounts,
        merge=merge_amounts,
        result=finish_amounts,
        accumulator="n bigint, cents bigint, largest bigint",
        output="n bigint, total double, largest double",
    )


def split_words(lines: pd.DataFrame) -> pd.DataFrame:
    pieces = lines.assign(word=lines["text"].str.lower().str.findall(r"[a-z0-9_]+"))
    return pieces.explode("word").dropna(subset=["word"])[["conv_id", "turn", "word"]]


@query(
    r"""
SELECT conv_id, turn, word, count(*) AS cnt
FROM (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '\w+')) AS word FROM conversations)
GROUP BY ALL
"""
)
def user_flat_map(spark: SparkSession, folder: str) -> DataFrame:
    """User code that gives several rows per row, counted by Spark."""
    lines = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    found = fold.flat_map(lines, split_words, "conv_id bigint, turn bigint, word string")
    return found.groupBy("conv_id", "turn", "word").agg(F.count("*").alias("cnt"))
