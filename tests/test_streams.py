"""Streams against their batch twins, for several cuts of the input, restarts and timers."""

import time

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, write_in_turn
from tallybrook import sinks, sources
from tallybrook.operators import count_trigger, late, lookup, parse, running, tokens, windows
from tallybrook.session import shared_folder
from tallybrook.streaming import carried
from tallybrook.streaming.late import split_late_stream
from tallybrook.streaming.ordered import flag_small_then_large_stream, running_stream, top_k_stream
from tallybrook.streaming.windows import count_trigger_stream, window_agg_when_idle

# Row numbers at which the input is cut into batches; the registered queries take it in one.
CUTS = [1, 40, 170]


def events(spark):
    """200 rows; times mostly rise with ``seq``, half of the rows are of one card."""
    return spark.range(200).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5 + 1).alias("card"),
        at(F.col("id") * 2 + F.pmod(F.hash("id"), F.lit(30))).alias("ts"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(400)).alias("cents"),
    )


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    """The events as files that a stream reads one per batch."""
    return write_in_turn(events(spark), tmp_path_factory.mktemp("events") / "files", CUTS)


def stream(spark, folder):
    return sources.table_stream(spark, folder, "ts", maxFilesPerTrigger=1)


ORDER = ["seq"]


def test_running(spark, turns, tmp_path):
    want = running.running_avg(
        running.running_total(
            running.running_count(events(spark), ["card"], ORDER), ["card"], ORDER, "cents"
        ),
        ["card"], ORDER, "cents",
    )
    columns = ["card", "seq", "n", "total", "average"]
    got = sinks.replay_append(running_stream(stream(spark, turns), ["card"], ORDER, "cents"))
    assert rows(got, *columns) == rows(want, *columns)
    got = carried.running_carried(stream(spark, turns), ["card"], ORDER, "cents", rows_per_chunk=20)
    assert rows(got, *columns[:-1]) == rows(want, *columns[:-1])


def test_running_decimal_carried(spark, turns):
    exact = F.col("cents").cast("decimal(12,2)")
    got = carried.running_carried(
        stream(spark, turns).withColumn("amount", exact), ["card"], ORDER, "amount"
    )
    want = running.running_total(events(spark).withColumn("amount", exact), ["card"], ORDER, "amount")
    assert rows(got, "seq", "total") == rows(want, "seq", "total")


def test_pair_flags(spark, turns):
    rule = dict(small=100, large=200)
    want = running.flag_small_then_large(events(spark), ["card"], ORDER, "cents", **rule)
    near = running.flag_small_then_large(
        events(spark), ["card"], ORDER, "cents", ts="ts", max_gap_seconds=9, **rule
    )
    assert 0 < near.where("flagged").count() < want.where("flagged").count()
    got = sinks.replay_append(
        flag_small_then_large_stream(stream(spark, turns), ["card"], ORDER, "cents", **rule)
    )
    assert rows(got, "seq", "flagged") == rows(want, "seq", "flagged")
    gap = dict(ts="ts", max_gap_seconds=9, **rule)
    got = sinks.replay_append(
        flag_small_then_large_stream(stream(spark, turns), ["card"], ORDER, "cents", **gap)
    )
    assert rows(got, "seq", "flagged") == rows(near, "seq", "flagged")
    got = carried.flag_small_then_large_carried(
        stream(spark, turns), ["card"], ORDER, "cents", rows_per_chunk=20, **gap
    )
    assert rows(got, "seq", "flagged") == rows(near, "seq", "flagged")


def test_top_k(spark, turns):
    best = [F.col("cents").desc(), F.col("seq")]
    entered = sinks.replay_append(top_k_stream(stream(spark, turns), ["card"], ORDER, "cents", 3))
    want = running.top_k(events(spark), ["card"], best, 3)
    assert rows(running.top_k(entered.drop("rank"), ["card"], best, 3), "card", "seq", "rank") == rows(
        want, "card", "seq", "rank"
    )
    assert entered.count() > want.count()


def test_latest_totals(spark, turns):
    got = sinks.replay_update(running.latest_total(stream(spark, turns), ["card"], "cents"), ["card"])
    want = running.latest_total(events(spark), ["card"], "cents")
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("keys", [[], ["card"]])
def test_count_trigger(spark, turns, keys):
    columns = ["window_start", *keys, "firing", "total", "n"]
    want = count_trigger.count_trigger_sums(events(spark), "ts", 60, "cents", 4, ORDER, keys=keys)
    # On these files each batch holds later rows, but a window's rows may come in several batches.
    fired = sinks.replay_append(
        count_trigger_stream(stream(spark, turns), "ts", 60, "cents", 4, ORDER, keys=keys, echo=True)
    )
    assert rows(fired.where("kind = 'sum'"), *columns) == rows(want, *columns)
    assert rows(fired.where("kind = 'input'").agg(F.sum("n"), F.sum("total"))) == rows(
        events(spark).agg(F.count("*"), F.sum("cents"))
    )
    got = carried.count_trigger_carried(
        stream(spark, turns), "ts", 60, "cents", 4, ORDER, keys=keys, rows_per_chunk=20
    )
    assert rows(got, *columns) == rows(want, *columns)


@pytest.mark.parametrize("keys", [[], ["card"]])
def test_late_rows(spark, turns, keys):
    options = dict(delay_seconds=3, lateness_seconds=4)
    want = late.split_late(events(spark), "ts", ORDER, 10, keys=keys, **options)
    assert 0 < late.late(want).count() < 100
    got = carried.split_late_carried(
        stream(spark, turns), "ts", ORDER, 10, keys=keys, rows_per_chunk=20, **options
    )
    columns = ["seq", "card", "ts", "prior_max_ts", "window_start", "window_end", "is_late"]
    assert rows(got, *columns) == rows(want, *columns)
    if not keys:
        return
    tagged = sinks.replay_append(
        split_late_stream(stream(spark, turns), "ts", ORDER, "cents", 10, keys, **options)
    ).cache()
    marked = tagged.where("kind != 'window'").withColumn("is_late", F.col("kind") == "late")
    assert rows(marked, *columns) == rows(want, *columns)
    # The last revision of a window has all its accepted rows; revisions count up without gaps.
    emitted = tagged.where("kind = 'window'").groupBy("card", "window_start").agg(
        F.max("n").alias("n"), F.max("revision").alias("revision"), F.count("*").alias("times")
    )
    assert emitted.where("revision + 1 != times").count() == 0
    accepted = late.on_time(want).groupBy("card", "window_start").agg(F.count("*").alias("n"))
    ended = want.groupBy("card").agg(F.max("ts").alias("end"))
    closed = accepted.join(ended, "card").where("end >= window_start + interval 13 seconds")
    assert rows(emitted, "card", "window_start", "n") == rows(closed, "card", "window_start", "n")
    tagged.unpersist()


def test_late_windows_and_revisions(spark, tmp_path):
    arrived = [(0, 1), (1, 5), (2, 13), (3, 6), (4, 3), (5, 15), (6, 4)]
    df = spark.createDataFrame(arrived, "seq long, s long").select(
        "seq", F.lit("s1").alias("id"), at("s").alias("ts"), F.col("s").alias("value")
    )
    for name, cuts in {"one": [], "some": [2, 3, 5]}.items():
        folder = write_in_turn(df, tmp_path / name, cuts)
        source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        tagged = sinks.replay_append(
            split_late_stream(source, "ts", ["seq"], "value", 10, ["id"], delay_seconds=2, lateness_seconds=2)
        )
        assert rows(tagged.where("kind = 'late'"), "value") == [(4.0,)]
        # 13 closes [0,10); 6 and 3 are within the allowed lateness and revise it.
        assert rows(tagged.where("kind = 'window'"), "revision", "n", "total") == [
            (0, 2, 6.0), (1, 3, 12.0), (2, 4, 15.0),
        ]


def test_windowed_aggregates_on_a_stream(spark, turns):
    in_time = stream(spark, turns)
    counted = windows.window_agg(
        in_time, "ts", 20, ["card"], {"n": F.count("*"), "hi": F.max("cents")}, delay_seconds=60
    )
    want = windows.window_agg(events(spark), "ts", 20, ["card"], {"n": F.count("*"), "hi": F.max("cents")})
    (end,) = events(spark).agg(F.max("ts")).first()
    passed = want.where(F.col("window_end") <= F.lit(end) - F.expr("interval 60 seconds"))
    assert rows(sinks.replay_append(counted)) == rows(passed)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    whole = events(spark)
    folder = tmp_path / "grow"
    write_in_turn(whole.where("seq < 90"), folder, [50])
    first = {}
    runs = {
        "append": lambda f: sinks.replay_append(
            running_stream(stream(spark, str(folder)), ["card"], ORDER, "cents"), f
        ),
        "carried": lambda f: carried.running_carried(
            stream(spark, str(folder)), ["card"], ORDER, "cents", f
        ),
    }
    for name, run in runs.items():
        first[name] = run(str(tmp_path / name)).count()
    assert set(first.values()) == {90}
    write_in_turn(whole.where("seq >= 90"), tmp_path / "rest", [])
    (tmp_path / "rest" / "000.parquet").rename(folder / "later.parquet")
    want = running.running_total(whole, ["card"], ORDER, "cents")
    for name, run in runs.items():
        assert rows(run(str(tmp_path / name)), "seq", "total") == rows(want, "seq", "total")


def wait_for(query, condition, seconds=40):
    end = time.time() + seconds
    while time.time() < end and not condition():
        assert query.exception() is None, query.exception()
        time.sleep(0.5)
    return condition()


def start_memory(df, name, tmp_path):
    return (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / name)).trigger(processingTime="1 second").start()
    )


def test_window_fires_while_the_stream_is_idle(spark, tmp_path):
    folder = write_in_turn(events(spark), tmp_path / "once", [])
    ingested = stream(spark, folder).withColumn("at", F.current_timestamp())
    query = start_memory(window_agg_when_idle(ingested, "at", 2, ["card"], "cents"), "idle", tmp_path)
    try:
        assert wait_for(query, lambda: spark.table("idle").count() == 6)
    finally:
        query.stop()
    want = events(spark).groupBy("card").agg(F.count("*"), F.sum("cents").cast("double"), F.max("cents").cast("double"))
    assert rows(spark.table("idle"), "card", "n", "total", "largest") == rows(want)


def test_remainder_is_dropped_or_emitted_at_the_window_end(spark, tmp_path):
    folder = write_in_turn(events(spark).where("seq < 13"), tmp_path / "some", [])
    ingested = stream(spark, folder).withColumn("at", F.current_timestamp())
    fired = count_trigger_stream(
        ingested, "at", 2, "cents", 5, ORDER, clear_at_end=True, emit_remainder=True
    )
    query = start_memory(fired, "rest", tmp_path)
    try:
        assert wait_for(query, lambda: spark.table("rest").count() == 3)
    finally:
        query.stop()
    assert sorted(n for (n,) in rows(spark.table("rest"), "n")) == [3, 5, 5]
    with pytest.raises(ValueError):
        count_trigger_stream(ingested, "at", 2, "cents", 5, ORDER, emit_remainder=True)


def test_running_state_with_ttl(spark, tmp_path):
    # State that expires keeps a stream running, so it needs a trigger other than availableNow.
    folder = write_in_turn(events(spark), tmp_path / "files", [100])
    totals = running_stream(stream(spark, folder), ["card"], ORDER, "cents", ttl_seconds=3600)
    query = start_memory(totals, "ttl", tmp_path)
    try:
        assert wait_for(query, lambda: spark.table("ttl").count() == 200)
    finally:
        query.stop()
    want = running.running_total(events(spark), ["card"], ORDER, "cents")
    assert rows(spark.table("ttl"), "seq", "total") == rows(want, "seq", "total")


def test_line_stream_and_fan_out(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a b\nb c")
    lines = sources.line_stream(spark, str(tmp_path / "in"))
    assert lines.columns == ["value", "ts"]
    out = str(tmp_path / "out")
    query = sinks.fan_out(
        tokens.tokenize(lines),
        [
            lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/words/batch={number}"),
            lambda batch, number: batch.groupBy("word").count().write.mode("overwrite").parquet(f"{out}/counts/batch={number}"),
        ],
        str(tmp_path / "check"),
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{out}/words"), "word") == [("a",), ("b",), ("b",), ("c",)]
    assert rows(spark.read.parquet(f"{out}/counts"), "word", "count") == [("a", 1), ("b", 2), ("c", 1)]


def test_order_lines_to_sales(spark, tmp_path):
    """Text lines, parsed, priced and summed per window, on a stream."""
    (tmp_path / "orders").mkdir()
    (tmp_path / "orders" / "a.txt").write_text("s1,towel,2\n\ns2,toothbrush,3\ns3,towel\ns4,soap,4")
    (tmp_path / "orders" / "b.txt").write_text("s5,towel,3")
    prices = sources.dimension(spark, {"towel": 10.0, "toothbrush": 5.0})
    orders = parse.parse_csv_records(
        sources.line_stream(spark, str(tmp_path / "orders"), maxFilesPerTrigger=1).select(
            "value", at(F.lit(7)).alias("ts")
        ),
        "order_id string, product string, qty int",
    )
    priced = lookup.lookup(orders, prices, "product", "price", default=1.0)
    sales = windows.window_sum(
        priced.withColumn("subtotal", F.col("qty") * F.col("price")),
        "ts", 10, ["product"], "subtotal", delay_seconds=None,
    )
    got = sinks.replay_update(sales, ["window_start", "product"])
    assert rows(got, "product", "total") == [("soap", 4.0), ("toothbrush", 15.0), ("towel", 50.0)]
    large = lookup.lookup(orders, prices, "product", "price", default=1.0, max_broadcast_rows=1)
    assert rows(sinks.replay_append(large), "order_id", "price") == [
        ("s1", 10.0), ("s2", 5.0), ("s4", 1.0), ("s5", 10.0),
    ]


def test_random_int_stream(spark, tmp_path):
    numbers = sources.random_int_stream(spark, 1, 3, rows_per_second=50)
    query = start_memory(numbers, "numbers", tmp_path)
    try:
        assert wait_for(query, lambda: spark.table("numbers").count() >= 50)
    finally:
        query.stop()
    assert {v for (v,) in rows(spark.table("numbers").select("v").distinct())} == {1, 2, 3}


def test_print_stream(spark, turns, tmp_path):
    query = sinks.print_stream(stream(spark, turns).select("seq"), str(tmp_path / "c"), name="shown")
    query.processAllAvailable()
    query.stop()
    assert query.name == "shown" and sum(p["numInputRows"] for p in query.recentProgress) == 200


def test_delimited_sink(spark, tmp_path):
    path = str(tmp_path / "counts")
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, cnt long")
    sinks.write_delimited(df, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a 2", "b 1"]
    with pytest.raises(Exception, match="already exists"):
        sinks.write_delimited(df, path)


def test_shared_folder(spark):
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert one != two and "/x-" in one and (not root or one.startswith(root))


# --- edges: the same in batches as at rest --------------------------------------------------------

EDGES = [
    # seq, card, ts, cents: ties over batches, nulls and NaN
    (10, 1, 10, 7.0), (11, 1, 11, 7.0), (12, 1, 12, 7.0), (13, 2, 13, None), (14, 2, 14, 7.0),
    (15, 3, None, 50.0), (16, 3, 16, 300.0), (17, 4, 17, float("nan")), (18, 4, 18, 1.0),
    (1, 1, 19, 7.0), (2, 2, 20, None), (3, 3, 21, 60.0), (4, 3, None, 300.0), (5, 4, 22, 2.0), (6, 5, 23, None),
]


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(EDGES)], "at long, seq long, card long, second long, cents double")
    return df.withColumn("ts", at(F.col("second"))).drop("second")


def test_top_k_ties_and_nulls(spark, edges):
    best = [F.col("cents").desc(), F.col("seq")]
    want = running.top_k(edges, ["card"], best, 3)
    keyed = sinks.replay_slices(edges, "at", lambda s, f: sinks.replay_append(top_k_stream(s, ["card"], ORDER, "cents", 3), f))
    by_batch = sinks.replay_slices(edges, "at", lambda s, f: carried.top_k_carried(s, ["card"], ORDER, "cents", 3, f))
    for got in (keyed, by_batch):
        final = running.top_k(got.drop("rank").distinct(), ["card"], best, 3)
        assert rows(final, "card", "seq", "rank") == rows(want, "card", "seq", "rank")


def test_pair_flags_with_null_times(spark, edges):
    rule = dict(small=100, large=200, ts="ts", max_gap_seconds=9)
    numbered = edges.withColumn("seq", F.col("at"))
    want = running.flag_small_then_large(numbered, ["card"], ORDER, "cents", **rule)
    keyed = sinks.replay_slices(
        numbered, "at", lambda s, f: sinks.replay_append(flag_small_then_large_stream(s, ["card"], ORDER, "cents", **rule), f)
    )
    assert rows(keyed, "seq", "flagged") == rows(want, "seq", "flagged")


def test_trigger_of_nulls(spark, edges):
    numbered = edges.withColumn("seq", F.col("at")).withColumn("v", F.when(F.col("seq") > 7, F.col("seq")))
    columns = ["window_start", "firing", "total", "n"]
    numbered = numbered.withColumn("ts", at(F.lit(1)))
    want = count_trigger.count_trigger_sums(numbered, "ts", 60, "v", 2, ORDER)
    assert want.where("total IS NULL").count() > 0
    for replay in (
        lambda s, f: sinks.replay_append(count_trigger_stream(s, "ts", 60, "v", 2, ORDER), f),
        lambda s, f: carried.count_trigger_carried(s, "ts", 60, "v", 2, ORDER, folder=f),
    ):
        assert rows(sinks.replay_slices(numbered, "at", replay), *columns) == rows(want, *columns)


def test_batches_do_not_grow_with_earlier_windows(spark, tmp_path):
    df = spark.range(600).select("id", at(F.col("id") * 2).alias("ts"), F.lit(1).alias("v"))
    folder = str(tmp_path / "trigger")
    replay = lambda s, _: carried.count_trigger_carried(s, "ts", 60, "v", 7, ["id"], folder=folder, expire_seconds=60)
    sinks.replay_slices(df, "id", replay, 6)
    written = [r["count"] for r in spark.read.parquet(f"{folder}/rows").groupBy("batch").count().orderBy("batch").collect()]
    assert len(written) == 6 and max(written) < 1.5 * min(written)
    carried_on = [spark.read.parquet(f"{folder}/carried/slot={k}").count() for k in range(3)]
    assert max(carried_on) < 10


def test_slices_of_a_table_of_many_files(spark, tmp_path):
    """Unordered files and several batches give what the table at rest gives."""
    events(spark).repartition(5, F.hash("seq")).write.parquet(str(tmp_path / "events"))
    table = spark.read.parquet(str(tmp_path / "events"))
    batches = []

    def replay(source, folder):
        batches.append(folder)
        return carried.running_carried(source, ["card"], ORDER, "cents", folder)

    got = sinks.replay_slices(table, "seq", replay, 5)
    want = running.running_total(running.running_count(events(spark), ["card"], ORDER), ["card"], ORDER, "cents")
    assert len(batches) == 5 and len(set(batches)) == 1
    assert rows(got, "card", "seq", "n", "total") == rows(want, "card", "seq", "n", "total")


def test_a_stream_has_to_say_how_late_its_rows_may_be(spark, turns):
    with pytest.raises(ValueError):
        windows.window_count(stream(spark, turns), "ts", 10, ["card"])


def test_print_shows_every_row(spark, turns, tmp_path):
    printed = str(tmp_path / "printed")
    shown = stream(spark, turns).select("seq").withColumn("text", F.lit("long " * 10))
    query = sinks.print_stream(shown, str(tmp_path / "c"), printed)
    query.processAllAvailable()
    query.stop()
    lines = [r.value for r in sinks.printed_lines(spark, printed).collect()]
    assert sorted(lines) == sorted(f"{seq},{'long ' * 10}" for seq in range(200))


def test_removed_folder(spark, tmp_path):
    path = f"file://{tmp_path}/gone"
    spark.range(1).write.parquet(path)
    sinks.remove_folder(spark, path)
    assert not (tmp_path / "gone").exists()
