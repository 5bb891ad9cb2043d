"""Edge cases and properties of the batch operators."""

import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import at, lines, rows
from tallybrook import sources
from tallybrook.operators import count_trigger, fold, late, lookup, parse, running, scan, tokens, windows

ORDERS = "order_id string, product string, qty int"


def test_tokens_split_at_non_ascii_and_keep_underscore(spark):
    found = tokens.tokenize(lines(spark, "hé_llo a1-B", None, "", "  --  "))
    assert rows(found) == [("_llo",), ("a1",), ("b",), ("h",)]
    assert rows(tokens.tokenize(lines(spark, "A b"), lower=False)) == [("A",), ("b",)]


def test_csv_arity(spark):
    text = lines(
        spark, "", "  \t", None, "o1,towel", "o2,towel,2,,", "o3,towel,2,x", " o4 , towel ,\t2 ", ",,,", "o5,,3"
    )
    assert rows(parse.parse_csv_records(text, ORDERS)) == [
        ("o2", "towel", 2), ("o4", "towel", 2), ("o5", "", 3),
    ]
    prefix = parse.parse_csv_records(lines(spark, "s1,20,extra", "s1"), "id string, n int", exact=False)
    assert rows(prefix) == [("s1", 20)]


def test_bad_numbers(spark):
    text = lines(spark, "o1,towel,2.5", "o2,towel,+3", "o3,towel,x", "o4,towel", "o5,towel,7")
    assert rows(parse.parse_csv_records(text, ORDERS, on_bad="drop"), "qty") == [(3,), (7,)]
    with pytest.raises(PySparkException, match="bad value"):
        parse.parse_csv_records(text, ORDERS).collect()
    with pytest.raises(PySparkException, match="bad value"):
        # Also when the broken column is not asked for.
        parse.parse_csv_records(text, ORDERS).select("order_id").collect()
    both = parse.parse_csv_records(text, ORDERS, on_arity="quarantine", on_bad="quarantine")
    assert rows(parse.good(both), "order_id") == [("o2",), ("o5",)]
    assert rows(parse.bad(both), "bad_line", "bad_reason") == [
        ("o1,towel,2.5", "value"), ("o3,towel,x", "value"), ("o4,towel", "arity"),
    ]
    assert rows(both.where("bad_line is not null"), "order_id") == [(None,)] * 3


def test_mixed_policies(spark):
    text = lines(spark, "o1,towel,x", "o4,towel", "o5,towel,7")
    kept = parse.parse_csv_records(text, ORDERS, on_arity="quarantine", on_bad="drop")
    assert rows(kept, "order_id", "bad_reason") == [("o5", None), (None, "arity")]
    kept = parse.parse_csv_records(text, ORDERS, on_arity="drop", on_bad="quarantine")
    assert rows(kept, "order_id", "bad_reason") == [("o5", None), (None, "value")]


def test_pairs_fail_on_a_missing_field(spark):
    with pytest.raises(PySparkException, match="bad arity"):
        parse.parse_pairs(lines(spark, "s1"), "id string, t double").collect()
    read = parse.parse_pairs(lines(spark, " s1\t 1.5  more ", "s2 NaN"), "id string, t double")
    assert [r.id for r in read.orderBy("id").collect()] == ["s1", "s2"]
    with pytest.raises(ValueError):
        parse.parse_pairs(lines(spark, "s1 1"), "id string, t double", on_bad="ignore")


def facts(spark, n=3000):
    # A third of the rows have one key, a tenth none.
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 97))
        .alias("product"),
    )


def test_lookup_by_broadcast_and_by_shuffle_agree(spark):
    dim = spark.range(50).select(F.concat(F.lit("k"), "id").alias("product"), F.col("id").cast("double").alias("price"))
    dim = dim.unionByName(spark.createDataFrame([("hot", 7.0), (None, 5.0)], "product string, price double"))
    small = lookup.lookup(facts(spark), dim, "product", "price", default=1.0)
    large = lookup.lookup(facts(spark), dim, "product", "price", default=1.0, max_broadcast_rows=3)
    bytes_ = lookup.lookup(facts(spark), dim, "product", "price", default=1.0, max_broadcast_bytes=10)
    assert rows(small) == rows(large) == rows(bytes_)
    got = {r.product: r.price for r in small.collect()}
    assert got["hot"] == 7.0 and got["k3"] == 3.0 and got["k96"] == 1.0 and got[None] == 1.0
    assert small.count() == 3000


def test_lookup_hot_key_without_entry(spark):
    dim = spark.createDataFrame([("k1", 2.0)], "product string, price double")
    got = lookup.lookup(facts(spark), dim, "product", "price", default=1.0, max_broadcast_rows=0)
    assert rows(got.groupBy("price").count()) == rows(
        facts(spark).groupBy(F.when(F.col("product") == "k1", 2.0).otherwise(1.0).alias("price")).count()
    )


def test_lookup_rejects_duplicate_keys(spark):
    dim = spark.createDataFrame([("k1", 2.0), ("k1", 3.0)], "product string, price double")
    with pytest.raises(PySparkException, match="duplicate dimension key"):
        lookup.lookup(facts(spark), dim, "product", "price", default=1.0).collect()


def test_windows_are_half_open_and_epoch_aligned(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,), (None,)], "s long").select(at("s").alias("ts"))
    counts = windows.window_count(df, "ts", 10, [])
    millis = counts.select(F.unix_millis("window_start"), F.unix_millis("window_end"), "cnt")
    assert rows(millis) == [(-10000, 0, 1), (0, 10000, 2), (10000, 20000, 1)]


def test_window_sums_do_not_wrap(spark):
    df = spark.createDataFrame([(2**31 - 1,), (2**31 - 1,)], "v int").withColumn("ts", at(F.lit(0)))
    assert rows(windows.window_sum(df, "ts", 10, [], "v"), "total") == [(2**32 - 2,)]


def test_window_max_prefers_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "v double").withColumn("ts", at(F.lit(0)))
    (row,) = windows.window_max(df, "ts", 10, [], "v").collect()
    assert row["max"] != row["max"]


def skewed(spark, n=6000):
    """Half of the rows under one key, many equal times, null keys and null values."""
    return spark.range(n).select(
        F.col("id").alias("seq"),
        at(F.pmod(F.xxhash64("id"), F.lit(40))).alias("ts"),
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 211).alias("k"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(1000))).alias("v"),
    ).repartition(6)


OUTPUTS = {"n": "count", "s": "sum", "hi": "max", "lo": "min", "last": "last"}


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("max_chunks", [4096, 8])
def test_chunked_scan_equals_plain_scan(spark, keys, include_current, max_chunks):
    df = skewed(spark)
    outputs = {name: (how, F.col("v")) for name, how in OUTPUTS.items()}
    options = dict(include_current=include_current)
    plain = scan.prefix_scan(df, keys, ["ts", "seq"], outputs, rows_per_chunk=10**9, **options)
    cut = scan.prefix_scan(
        df, keys, ["ts", "seq"], outputs, rows_per_chunk=100, max_chunks=max_chunks, **options
    )
    assert cut.columns == plain.columns
    assert rows(cut) == rows(plain)


def test_chunks_split_the_hot_key_only_and_follow_the_order(spark):
    cut = scan.with_chunks(skewed(spark), ["k"], ["ts", "seq"], rows_per_chunk=200)
    sizes = cut.groupBy("k", "_chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("ts", "seq")).alias("lo"), F.max(F.struct("ts", "seq")).alias("hi")
    )
    hot = sizes.where("k = 0").orderBy("_chunk").collect()
    assert len(hot) > 8 and max(r.n for r in hot) < 3 * 200
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert rows(sizes.where("k > 0").agg(F.max("_chunk"))) == [(0,)]
    assert scan.with_chunks(skewed(spark), ["k"], ["ts", "seq"], rows_per_chunk=6000) is None


def test_number_of_chunks_is_bounded(spark):
    cut = scan.with_chunks(skewed(spark), [], ["seq"], rows_per_chunk=1, max_chunks=16)
    assert 8 <= cut.select("_chunk").distinct().count() <= 32


def test_last_running_value_is_the_total(spark):
    df = skewed(spark)
    running_ = running.running_total(df, ["k"], ["ts", "seq"], "v", rows_per_chunk=150)
    last = running_.groupBy("k").agg(F.max_by("total", F.struct("ts", "seq")).alias("total"))
    assert rows(last) == rows(df.groupBy("k").agg(F.sum("v").alias("total")))


def test_running_average(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 4), (1, 3, 8)], "k int, seq int, v int")
    assert rows(running.running_avg(df, ["k"], ["seq"], "v"), "average") == [(4.0,), (6.0,), (None,)]


def test_pair_flag(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.5), (1, 10, 200.0), (1, 20, 300.0), (2, 0, 0.5), (2, 90, 200.0)], "card int, s int, amount double"
    ).withColumn("ts", at("s"))
    rule = dict(small=1.0, large=100.0)
    flagged = running.flag_small_then_large(df, ["card"], ["s"], "amount", **rule).where("flagged")
    assert rows(flagged, "card", "s") == [(1, 10), (2, 90)]
    near = running.flag_small_then_large(
        df, ["card"], ["s"], "amount", ts="ts", max_gap_seconds=60, **rule
    ).where("flagged")
    assert rows(near, "card", "s") == [(1, 10)]


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 0), (1, 9, 2), (2, 1, 3)], "card int, amount int, seq int")
    top = running.top_k(df, ["card"], [F.col("amount").desc(), F.col("seq")], 2)
    assert rows(top, "card", "seq", "rank") == [(1, 0, 2), (1, 2, 1), (2, 3, 1)]


@pytest.mark.parametrize("rows_per_chunk", [50, 10**9])
def test_firings_and_remainder_make_up_the_input(spark, rows_per_chunk):
    df = skewed(spark).where("v is not null")
    fired = count_trigger.count_trigger_sums(
        df, "ts", 20, "v", 7, ["ts", "seq"], emit_remainder=True, rows_per_chunk=rows_per_chunk
    )
    assert rows(fired.agg(F.sum("total"), F.sum("n"))) == rows(df.agg(F.sum("v"), F.count("*")))
    full = count_trigger.count_trigger_sums(
        df, "ts", 20, "v", 7, ["ts", "seq"], rows_per_chunk=rows_per_chunk
    )
    assert rows(full) == rows(fired.where("n = 7"))
    assert full.count() == sum(n // 7 for _, _, n in rows(windows.window_count(df, "ts", 20, [])))
    with pytest.raises(ValueError):
        count_trigger.count_trigger_sums(df, "ts", 20, "v", 0, ["seq"])


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_late_split_by_brute_force(spark, keys):
    df = skewed(spark, 900)
    split = late.split_late(
        df, "ts", ["seq"], 10, delay_seconds=5, lateness_seconds=3, keys=keys, rows_per_chunk=60
    )
    largest, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: r.seq):
        key = r.k if keys else None
        s = int(r.ts.timestamp())
        before = largest.get(key)
        want[r.seq] = before is not None and before >= s // 10 * 10 + 10 + 5 + 3
        largest[key] = s if before is None else max(before, s)
    assert {r.seq: r.is_late for r in split.collect()} == want
    assert late.late(split).count() + late.on_time(split).count() == 900


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def add(part: pd.DataFrame) -> pd.DataFrame:
    return part.groupby("k", dropna=False)["v"].agg(n="size", s="sum").reset_index()


def merge(part: pd.DataFrame) -> pd.DataFrame:
    return part.groupby("k", dropna=False).agg({"n": "sum", "s": "sum"}).reset_index()


@pytest.mark.parametrize("flush_rows", [1, 50_000])
def test_fold(spark, flush_rows):
    df = skewed(spark).select("k", F.coalesce("v", F.lit(0)).cast("bigint").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        got = fold.fold_agg(
            df, ["k"], add=add, merge=merge, result=lambda part: part.assign(mean=part["s"] / part["n"]),
            accumulator="n bigint, s bigint", output="n bigint, mean double", flush_rows=flush_rows,
        )
        want = df.groupBy("k").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))
        assert rows(got) == rows(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_fold_windows(spark):
    df = skewed(spark).select("k", "ts", F.coalesce("v", F.lit(0)).cast("bigint").alias("v"))
    keys = ["window_start", "window_end", "k"]

    def count(part):
        return part.groupby(keys, dropna=False)["v"].agg(n="size").reset_index()

    def total(part):
        return part.groupby(keys, dropna=False)["n"].sum().reset_index()

    got = fold.fold_windows(
        df, "ts", 20, ["k"], add=count, merge=total, result=lambda p: p, accumulator="n bigint", output="n bigint"
    )
    assert rows(got) == rows(windows.window_count(df, "ts", 20, ["k"]))


def test_random_ints(spark):
    drawn = sources.random_ints(spark, 20_000, 3, 7, seed=5)
    counts = dict(rows(drawn.groupBy("v").count()))
    assert sorted(counts) == [3, 4, 5, 6, 7] and min(counts.values()) > 3600
    assert rows(drawn) == rows(sources.random_ints(spark, 20_000, 3, 7, seed=5).repartition(3))
    assert rows(drawn) != rows(sources.random_ints(spark, 20_000, 3, 7, seed=6))
    assert rows(sources.random_ints(spark, 5, 4, 4), "v") == [(4,)] * 5
    with pytest.raises(ValueError):
        sources.random_ints(spark, 5, 4, 3)
