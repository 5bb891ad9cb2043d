"""Sessions, revisions, common times and values as of a time against plain Python, for several chunk sizes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, write_in_turn
from tallybrook import sinks, sources
from tallybrook.operators import asof, inputs, late, revisions, sessions, windows
from tallybrook.streaming.metrics import LateCounter
from tallybrook.streaming.sessions import session_stream

CHUNKS = [{}, {"rows_per_chunk": 40}, {"rows_per_chunk": 7}]


def made(n=400, seed=1):
    """seq, key (half are 0, some null), second (in any order, some equal), v (some null)."""
    draw = random.Random(seed)
    return [
        (i, draw.choice([0, 0, 0, 1, 2, None]), draw.randrange(0, 6000), None if draw.random() < 0.1 else draw.randrange(100)) for i in range(n)
    ]


def frame(spark, data):
    return spark.createDataFrame(data, "seq long, k long, second long, v long").withColumn("ts", at(F.col("second")))


def seconds(df, *columns):
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


# --- sessions ---------------------------------------------------------------------------------


def plain_sessions(data, gap, keyed=True):
    found = []
    for k in {r[1] for r in data} if keyed else {0}:
        own = sorted((r[2], r[3]) for r in [(*r[:3], -1 if r[3] is None else r[3]) for r in data] if not keyed or r[1] == k)
        opened = None
        for second, v in own:
            if opened is None or second > opened[1]:
                opened = [second, 0, 0, 0, []]
                found.append((k, opened))
            opened[1] = second + gap
            opened[2] += 1
            opened[4].append(None if v < 0 else v)
    out = []
    for k, (start, end, n, _, values) in found:
        known = [v for v in values if v is not None]
        out.append((*([k] if keyed else []), start, end, n, sum(known) if known else None, max(known) if known else None))
    return sorted(out, key=repr)


def values():
    return {"n": ("count", F.lit(1)), "total": ("sum", F.col("v")), "largest": ("max", F.col("v"))}


def shown(df, *keys):
    return rows(seconds(df, "session_start", "session_end"), *keys, "session_start", "session_end", "n", "total", "largest")


@pytest.mark.parametrize("scan", CHUNKS)
@pytest.mark.parametrize("gap", [0, 5, 60])
def test_sessions(spark, scan, gap):
    data = made()
    assert shown(sessions.sessions(frame(spark, data), "ts", gap, ["k"], values(), **scan), "k") == plain_sessions(data, gap)
    assert shown(sessions.sessions(frame(spark, data), "ts", gap, [], values(), **scan)) == plain_sessions(data, gap, False)


def test_sessions_that_touch_are_one(spark):
    data = [(0, 1, 100, 1), (1, 1, 110, 2), (2, 1, 121, 3), (3, None, 0, None)]
    assert shown(sessions.sessions(frame(spark, data), "ts", 10, ["k"], values()), "k") == plain_sessions(data, 10)
    assert sessions.sessions(frame(spark, data).where("seq < 0"), "ts", 10, ["k"], values()).count() == 0
    timeless = frame(spark, data).withColumn("ts", F.lit(None).cast("timestamp"))
    assert sessions.sessions(timeless, "ts", 10, ["k"], values()).count() == 0


def test_parts_of_sessions_merge(spark):
    """Merged sessions of parts of the rows merge to those of all."""
    data = made(seed=3)
    df = frame(spark, data)
    parts = [sessions.sessions(df.where(F.col("seq") % 3 == i), "ts", 40, ["k"], values()) for i in range(3)]
    how = {"n": "count", "total": "sum", "largest": "max"}
    got = sessions.merge_sessions(parts[0].unionAll(parts[1]).unionAll(parts[2]), ["k"], how, rows_per_chunk=20)
    assert shown(got, "k") == plain_sessions(data, 40)


def streamed(spark, folder, gap, **options):
    stream = sources.table_stream(spark, folder, "ts", maxFilesPerTrigger=1)
    return session_stream(stream, "ts", gap, ["k"], values(), **options)


def test_sessions_of_a_stream_in_any_order(spark, tmp_path):
    data = made(seed=4)
    folder = write_in_turn(frame(spark, data), tmp_path / "in", [100, 101, 250], "seq")
    out = str(tmp_path / "out")
    last = sinks.replay_update(streamed(spark, folder, 40), ["k", "session_start"], out)
    assert shown(last.where("NOT merged"), "k") == plain_sessions(data, 40)
    written = spark.read.parquet(f"{out}/rows")
    assert written.where("merged").count() > 0  # sessions have met
    assert written.where("merged AND n IS NOT NULL").count() == 0


def test_a_row_between_two_sessions_joins_them(spark, tmp_path):
    data = [(0, 1, 100, 5), (1, 1, 120, 6), (2, 1, 110, 7), (3, 1, 500, None)]
    folder = write_in_turn(frame(spark, data), tmp_path / "in", [1, 2, 3], "seq")
    out = str(tmp_path / "out")
    last = sinks.replay_update(streamed(spark, folder, 10), ["k", "session_start"], out)
    assert shown(last.where("NOT merged"), "k") == plain_sessions(data, 10)
    by_batch = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    gone = by_batch.where("merged").select("batch", F.unix_seconds("session_start").alias("s")).collect()
    assert [(r.batch, r.s) for r in gone] == [(2, 120)]


def test_old_sessions_are_forgotten(spark, tmp_path):
    data = [(0, 1, 100, 5), (1, 1, 1000, 6), (2, 1, 105, 7)]
    folder = write_in_turn(frame(spark, data), tmp_path / "in", [1, 2], "seq")
    last = sinks.replay_update(streamed(spark, folder, 10, keep_seconds=60), ["k", "session_start"], str(tmp_path / "out"))
    got = shown(last.where("NOT merged"), "k")
    assert got == [(1, 100, 110, 1, 5, 5), (1, 1000, 1010, 1, 6, 6), (1, 105, 115, 1, 7, 7)]


# --- revisions --------------------------------------------------------------------------------


def plain_revisions(data, width, delay, lateness):
    windows_of, high, out = {}, None, []

    def add(start, row):
        n, total, revision = windows_of[start]
        out.append((start, revision, n, total, row))

    for i, _, second, v in sorted(data):
        start = second - second % width
        closing = start + width + delay
        if high is not None and high >= closing + lateness:
            high = max(high, second)
            continue
        window = windows_of.setdefault(start, [0, None, -1])
        window[0] += 1
        window[1] = v if window[1] is None else window[1] + (v or 0)
        if high is not None and high >= closing:
            window[2] += 1
            add(start, i)
        high = second if high is None else max(high, second)
        for other in sorted(windows_of):
            if windows_of[other][2] < 0 and other + width + delay <= high:
                windows_of[other][2] = 0
                add(other, i)
    return sorted(out, key=repr)


def drifting(n=400, seed=2):
    """Times that rise with the arrival, by jumps and with much disorder."""
    draw = random.Random(seed)
    return [(i, 0, max(0, 4 * i + 300 * (i // 150) + draw.randrange(-220, 220)), None if draw.random() < 0.2 else draw.randrange(100)) for i in range(n)]


@pytest.mark.parametrize("scan", CHUNKS)
@pytest.mark.parametrize("delay, lateness", [(0, 0), (30, 90), (0, 200), (100, 0)])
def test_revisions(spark, scan, delay, lateness):
    data = drifting()
    got = revisions.window_revisions(
        frame(spark, data), "ts", ["seq"], 60, F.col("v"), delay_seconds=delay, lateness_seconds=lateness, **scan
    )
    expected = plain_revisions(data, 60, delay, lateness)
    assert rows(seconds(got, "window_start"), "window_start", "revision", "n", "total", "seq") == expected
    assert not lateness or any(r[1] > 1 for r in expected)


def test_revisions_of_edges(spark):
    empty = frame(spark, drifting()).where("seq < 0")
    assert revisions.window_revisions(empty, "ts", ["seq"], 60, F.col("v")).count() == 0
    one = frame(spark, [(0, 0, 5, 1)])  # never closes
    assert revisions.window_revisions(one, "ts", ["seq"], 60, F.col("v")).count() == 0


# --- several inputs ---------------------------------------------------------------------------


def plain_common(data, n_inputs, idle):
    marks, last, first, common, out = {}, {}, None, None, []
    for seq, source, second, arrived in data:
        if first is not None:
            active = [j for j in range(n_inputs) if arrived - last.get(j, first) <= idle]
            if active and all(j in marks for j in active):
                least = min(marks[j] for j in active)
                common = least if common is None else max(common, least)
        out.append((seq, common))
        first = arrived if first is None else first
        last[source] = arrived
        marks[source] = max(marks.get(source, second), second)
    return out


@pytest.mark.parametrize("scan", CHUNKS)
@pytest.mark.parametrize("idle", [5, 60, 100_000])
def test_common_time(spark, scan, idle):
    draw = random.Random(idle)
    data, clock = [], 0
    for i in range(300):
        clock += draw.choice([0, 1, 2, 3, 70 if i % 50 == 0 else 1])
        source = draw.choice([0, 1, 1, 2] if 60 < i < 150 else [0, 1])  # the third input is late and falls silent
        data.append((i, source, max(0, clock - draw.randrange(40)), clock))
    df = spark.createDataFrame(data, "seq long, input int, second long, arrived long")
    df = df.withColumns({"ts": at(F.col("second")), "arrival": at(F.col("arrived"))})
    got = inputs.common_time(df, "ts", "arrival", ["arrival", "seq"], "input", [0, 1, 2], idle_seconds=idle, **scan)
    assert rows(seconds(got, "common_ts"), "seq", "common_ts") == sorted(plain_common(data, 3, idle), key=repr)


def test_one_input_is_the_plain_rule(spark):
    df = frame(spark, drifting()).withColumns({"arrival": at(F.col("seq")), "input": F.lit(0)})
    got = inputs.split_late_inputs(df, "ts", "arrival", ["arrival", "seq"], "input", [0], 60, idle_seconds=10**6, delay_seconds=20, lateness_seconds=10)
    want = late.split_late(df, "ts", ["arrival", "seq"], 60, delay_seconds=20, lateness_seconds=10)
    assert rows(got, "seq", "is_late") == rows(want, "seq", "is_late")
    assert got.where("is_late").count() > 0


# --- as of ------------------------------------------------------------------------------------


@pytest.mark.parametrize("scan", CHUNKS)
def test_as_of(spark, scan):
    asked, told = made(300, 7), made(200, 8)
    asked.append((999, 0, None, 1))
    df, changes = frame(spark, asked).withColumnRenamed("v", "_valid"), frame(spark, told)
    got = asof.as_of(df, "ts", "seq", changes, "ts", "seq", ["k"], "v", default=-1, **scan)
    assert got.columns == ["seq", "k", "second", "_valid", "ts", "v"]
    expected = []
    for seq, k, second, mine in asked:
        before = [(s, i, v) for i, key, s, v in told if key == k and second is not None and s <= second]
        value = max(before)[2] if before else None
        expected.append((seq, mine, -1 if value is None else value))
    assert rows(got, "seq", "_valid", "v") == sorted(expected, key=repr)


def test_as_of_without_changes(spark):
    df = frame(spark, made(20))
    none = frame(spark, made(1)).where("seq < 0")
    assert rows(asof.as_of(df, "ts", "seq", none, "ts", "seq", ["k"], "v", out="w"), "w") == [(None,)] * 20
    assert asof.as_of(none, "ts", "seq", df, "ts", "seq", ["k"], "v").count() == 0


# --- late rows by number ------------------------------------------------------------------------


def test_dropped_and_emitted_rows_are_all_rows(spark, tmp_path):
    """Append mode: what the watermark drops is in the counter, all else in windows."""
    data = [(i, 0, s, 1) for i, s in enumerate([*range(0, 600, 10), 5, 15, 590, *range(600, 1200, 10), 7, 9, 11, 5000, 30, 9000])]
    folder = write_in_turn(frame(spark, data), tmp_path / "in", [20, 62, 100, 124, 125, 126], "seq")
    counter = LateCounter("dropped-and-emitted")
    spark.streams.addListener(counter)
    try:
        counted = windows.window_count(sources.table_stream(spark, folder, "ts", maxFilesPerTrigger=1), "ts", 60, [], delay_seconds=30)
        query = (
            counted.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).queryName("dropped-and-emitted")
            .trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        deadline = datetime.datetime.now() + datetime.timedelta(seconds=30)
        while sum(b.rows_in for b in counter.batches.values()) < len(data) and datetime.datetime.now() < deadline:
            pass
        emitted = spark.read.parquet(str(tmp_path / "out")).agg(F.sum("cnt")).first()[0]
        open_rows = 1  # the last row's window has not closed
        # The engine counts dropped rows after they were combined in the tasks: here a task has one row of a window.
        assert counter.dropped > 0
        assert emitted + counter.dropped + open_rows == len(data)
        assert [b.batch for b in counter.seen_by(query)] == sorted({b.batch for b in counter.batches.values()})
    finally:
        spark.streams.removeListener(counter)
