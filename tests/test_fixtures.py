"""The sample inputs and their results (FIXTURES.md), all rows in one window."""

from pathlib import Path

from pyspark.sql import functions as F

from helpers import at, lines, rows
from tallybrook import sources
from tallybrook.operators import count_trigger, late, lookup, parse, running, tokens, windows

LATE_EVENTS = [(0, 1), (1, 5), (2, 13), (3, 6), (4, 3), (5, 15), (6, 4)]


def fixture(heading: str) -> list[str]:
    """The lines of the first block below a heading of FIXTURES.md."""
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    return text.split(heading, 1)[1].split("```")[1].strip().splitlines()


def test_word_count(spark):
    text = ["The grey heron stood; the heron waited.", "Waited, and waited: grey water, grey sky!", "", "42 herons"]
    assert rows(tokens.word_count(lines(spark, *text))) == [
        ("42", 1), ("and", 1), ("grey", 3), ("heron", 2), ("herons", 1), ("sky", 1), ("stood", 1), ("the", 2),
        ("waited", 3), ("water", 1),
    ]


def test_running_letter_count(spark):
    numbered = lines(spark, *fixture("### sentences")).withColumn("seq", F.monotonically_increasing_id())
    found = tokens.containing(tokens.tokenize(numbered, position="at"), "word", "a")
    log = rows(running.running_count(found, ["word"], ["seq", "at"]), "word", "n")
    assert log == [
        ("a", 1), ("a", 2), ("contains", 1), ("have", 1), ("program", 1), ("sample", 1),
        ("several", 1), ("that", 1),
    ]


def test_max_temperature(spark):
    parsed = parse.parse_pairs(lines(spark, "s1 2", "s2 3", "s3 4", "s1 6"), "id string, temp double")
    highest = windows.window_max(parsed.withColumn("ts", at(F.lit(1))), "ts", 5, ["id"], "temp")
    assert rows(highest, "id", "max") == [("s1", 6.0), ("s2", 3.0), ("s3", 4.0)]


def test_sales(spark, tmp_path):
    text = tmp_path / "orders.txt"
    text.write_text(
        "s10235,towel,2\ns10236,toothbrush,3\ns10237,toothbrush,7\ns10238,instantnoodles,5\n"
        "s10239,towel,3\ns10240,toothbrush,3\ns10241,instantnoodles,3"
    )
    prices = sources.dimension(spark, {"towel": 10.0, "toothbrush": 5.0, "instantnoodles": 3.0})
    orders = parse.parse_csv_records(
        sources.text_lines(spark, str(text)), "order_id string, product string, qty int"
    )
    priced = lookup.lookup(orders, prices, "product", "price", default=1.0)
    sales = windows.window_sum(
        priced.withColumn("subtotal", F.col("qty") * F.col("price")).withColumn("ts", at(F.lit(3))),
        "ts", 10, ["product"], "subtotal",
    )
    assert rows(sales, "product", "total") == [
        ("instantnoodles", 24.0), ("toothbrush", 65.0), ("towel", 50.0),
    ]


def test_vehicles(spark):
    parsed = parse.parse_pairs(
        lines(spark, "卡车 10", "燃油车 20", "电动车 20", "摩托车 10", "摩托车 30", "卡车 15", "燃油车 20"),
        "category string, cnt int",
    ).withColumn("ts", at(F.lit(12)))
    totals = windows.window_line(
        windows.window_sum(parsed, "ts", 10, ["category"], "cnt"), "category", "category", "total", "total"
    )
    assert rows(totals, "line") == sorted(
        [(f"category={c} window=[10000,20000) total={n}",)
         for c, n in {"卡车": 25, "燃油车": 40, "电动车": 20, "摩托车": 40}.items()], key=repr
    )


def test_water_levels(spark):
    parsed = parse.parse_csv_records(
        lines(spark, "s1,20", "s1,30", "s1,25", "s2,10", "s2,15", "s1,40", "s1,35", "s2,10", "s2,5"),
        "id string, level int", exact=False,
    ).withColumn("ts", at(F.lit(9)))
    highest = windows.window_line(
        windows.window_max(parsed, "ts", 10, ["id"], "level"), "id", "sensor", "max", "max"
    )
    assert rows(highest, "line") == [
        ("sensor=s1 window=[0,10000) max=40",), ("sensor=s2 window=[0,10000) max=15",),
    ]


def counted(spark):
    return spark.range(1, 13).select(
        F.col("id").alias("v"), at(F.when(F.col("id") <= 7, 0).otherwise(5)).alias("ts")
    )


def test_count_trigger(spark):
    fired = windows.firing_line(count_trigger.count_trigger_sums(counted(spark), "ts", 5, "v", 5, ["v"]))
    assert rows(fired, "line") == [("Sum of window> 15 (count=5)",), ("Sum of window> 50 (count=5)",)]
    rest = count_trigger.count_trigger_sums(
        counted(spark), "ts", 5, "v", 5, ["v"], emit_remainder=True
    )
    assert rows(rest, "total", "n") == [(13, 2), (15, 5), (50, 5)]


def test_late_events(spark):
    events = spark.createDataFrame(LATE_EVENTS, "seq long, s long").select(
        "seq", F.col("s").alias("value"), at("s").alias("ts")
    )
    cases = {(0, 0): 6, (2, 1): 6, (2, 2): 15, (5, 0): 15, (3, 3): 19, (8, 0): 19}
    lost = {6: [3, 4, 6], 15: [4], 19: []}
    for (delay, lateness), total in cases.items():
        split = late.split_late(
            events, "ts", ["seq"], 10, delay_seconds=delay, lateness_seconds=lateness
        )
        sums = late.on_time_windows(split, "ts", 10, [], {"total": F.sum("value")})
        assert rows(sums, "total") == sorted([(total,), (28,)], key=repr)
        assert [v for (v,) in rows(late.late(split), "value")] == lost[total]


def test_watermark_trace(spark):
    events = spark.createDataFrame(LATE_EVENTS, "seq long, s long").select("seq", at("s").alias("ts"))
    trace = late.watermark_trace(events, "ts", ["seq"], delay_seconds=2)
    assert dict(rows(trace)) == {
        0: None, 1: -1001, 2: 2999, 3: 10999, 4: 10999, 5: 10999, 6: 12999,
    }
