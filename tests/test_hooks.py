"""User code on streams and windows, the print sink's commits, and the random source."""

import json
import resource
import sys
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import at, rows, write_in_turn
from tallybrook import sinks, sources
from tallybrook.operators import fold, windows
from tallybrook.sinks.printing import PrintWriter, Written
from tallybrook.sources.random_source import draw, random_loops
from tallybrook.streaming.folds import fold_stream, fold_windows_stream
from tallybrook.streaming.windows import count_trigger_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numbers(spark, n=200):
    """Half of the rows have key 0; some keys and values are null."""
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 10 != 9, F.col("id") % 5 + 1).alias("k"),
        at(F.col("id") * 3).alias("ts"),
        F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).alias("v"),
    )


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    return write_in_turn(numbers(spark), tmp_path_factory.mktemp("numbers") / "files", [1, 40, 170])


def stream(spark, folder):
    return sources.table_stream(spark, folder, "ts", maxFilesPerTrigger=1)


# --- user folds ---------------------------------------------------------------------------------


def code(*keys):
    """A user's fold with numbers, a text and an array: count, least and largest value, and the last digits seen."""
    keys = list(keys)

    def add(part):
        part = part.assign(digit=(part["seq"] % 3).astype(str))
        found = part.groupby(keys, dropna=False)
        return found.agg(n=("seq", "size"), low=("v", "min"), digits=("digit", lambda d: "".join(sorted(set(d))))).reset_index()

    def merge(parts):
        found = parts.groupby(keys, dropna=False)
        return found.agg(n=("n", "sum"), low=("low", "min"), digits=("digits", lambda d: "".join(sorted(set("".join(d)))))).reset_index()

    def result(parts):
        return parts.assign(line=parts["digits"] + ":" + parts["n"].astype(str))

    return dict(add=add, merge=merge, result=result, accumulator="n bigint, low double, digits string", output="n bigint, low double, line string")


def plain(found):
    """NaN and null are the same to pandas."""
    return sorted(((*(None if v != v else v for v in r),) for r in found), key=repr)


def test_fold_of_a_stream_is_that_of_the_table(spark, turns):
    got = sinks.replay_update(fold_stream(stream(spark, turns).select("seq", "k", "v"), ["k"], **code("k")), ["k"])
    want = fold.fold_agg(numbers(spark).select("seq", "k", "v"), ["k"], **code("k"))
    columns = ["k", "n", "low", "line"]
    assert plain(got.select(columns).collect()) == plain(want.select(columns).collect())
    assert sum(r.n for r in got.collect()) == 200


def test_fold_goes_on_after_a_restart(spark, tmp_path):
    """One change for each key and batch; a second start goes on with what the state holds."""
    files, out = tmp_path / "in", str(tmp_path / "out")
    numbers(spark).where("seq < 50").coalesce(1).write.parquet(str(files))
    folded = lambda: fold_stream(sources.table_stream(spark, str(files)).select("seq", "k", "v"), ["k"], **code("k"))
    first = sinks.replay_update(folded(), ["k"], out)
    assert {r.k: r.n for r in first.collect()}[0] == 25
    numbers(spark).where("seq >= 50").coalesce(1).write.mode("append").parquet(str(files))
    again = sinks.replay_update(folded(), ["k"], out)
    assert {r.k: r.n for r in again.collect()}[0] == 100
    written = spark.read.parquet(f"{out}/rows").where("k = 0").select("n").collect()
    assert sorted(r.n for r in written) == [25, 100]


def test_keys_of_a_stream_are_folded_together(spark, tmp_path):
    """Pages of few keys are split while batches come; the user's code is given many keys at a time, null ones too."""
    source = spark.range(900).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 300 < 298, F.col("id") % 300).alias("k"),
        F.when(F.col("id") % 300 == 299, F.lit(float("nan"))).when(F.col("id") % 3 < 2, F.col("id") % 3 / 2).alias("x"),
        F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).alias("v"),
    )
    given = sources.table_stream(spark, write_in_turn(source, tmp_path / "files", [20, 500]), maxFilesPerTrigger=1)
    own = code("k", "x")
    counted = {**own, "result": lambda parts: own["result"](parts).assign(keys=len(parts)), "output": own["output"] + ", keys bigint"}
    folded = fold_stream(given, ["k", "x"], **counted, buckets=2, keys_per_page=3)
    got = sinks.replay_update(folded, ["k", "x"]).select("k", "x", "n", "low", "line", "keys").collect()
    want = fold.fold_agg(source, ["k", "x"], **own).select("k", "x", "n", "low", "line").collect()
    assert len(want) > 290 and plain(r[:5] for r in got) == plain(want)
    assert max(r["keys"] for r in got) > 20


def test_fold_by_windows(spark, turns):
    keys = ["window_start", "window_end", "k"]
    rows_of = stream(spark, turns).select("ts", "seq", "k", "v")
    got = sinks.replay_update(fold_windows_stream(rows_of, "ts", 60, ["k"], **code(*keys)), keys)
    want = fold.fold_windows(numbers(spark).select("ts", "seq", "k", "v"), "ts", 60, ["k"], **code(*keys))
    columns = [*keys, "n", "low", "line"]
    assert plain(got.select(columns).collect()) == plain(want.select(columns).collect())


# --- windows row by row ---------------------------------------------------------------------------


class Summary(fold.WindowProcess):
    """Rows in order, as told by their numbers, and how many there were."""

    def __init__(self):
        self.seen, self.rising, self.memory, self.high = 0, True, 0, -1

    def row(self, row):
        self.rising &= row["seq"] > self.high
        self.high = row["seq"]
        self.seen += 1
        if self.seen == 1000:
            self.memory = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        return ()

    def end(self):
        grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - self.memory if self.memory else 0
        yield self.seen, self.rising, grown
        yield -self.seen, self.rising, grown


def test_process_gets_each_window_in_order(spark):
    found = fold.process_windows(numbers(spark).repartition(5), "ts", 60, ["k"], ["seq"], Summary, "n int, rising boolean, grown bigint")
    counted = windows.window_count(numbers(spark), "ts", 60, ["k"], out="n")
    assert rows(found.where("n > 0"), "window_start", "window_end", "k", "n") == rows(counted, "window_start", "window_end", "k", "n")
    assert found.where("rising").count() == 2 * counted.count()


def test_a_window_larger_than_a_batch_keeps_memory_flat(spark):
    """300 MB of rows in one window."""
    wide = spark.range(300_000).select(
        F.col("id").alias("seq"), at(F.lit(5)).alias("ts"), F.repeat(F.lit("x"), F.lit(1000)).alias("ballast")
    )
    (a, b) = fold.process_windows(wide, "ts", 60, [], ["seq"], Summary, "n int, rising boolean, grown bigint").collect()
    assert {a.n, b.n} == {300_000, -300_000} and a.rising
    assert a.grown < 60_000  # kB


def test_process_of_edges(spark):
    empty = numbers(spark).where("seq < 0")
    output = "n int, rising boolean, grown bigint"
    assert fold.process_windows(empty, "ts", 60, ["k"], ["seq"], Summary, output).count() == 0
    timeless = spark.createDataFrame([(1, None)], "seq long, ts timestamp")
    assert fold.process_windows(timeless, "ts", 60, [], ["seq"], Summary, output).count() == 0


# --- print --------------------------------------------------------------------------------------


def test_a_batch_that_runs_again_is_printed_once(spark, turns, tmp_path):
    """The last batch's commit is taken back after its lines are out, as if the driver had died between."""
    printed, checkpoint = str(tmp_path / "printed"), tmp_path / "checkpoint"

    def run():
        query = sinks.print_stream(stream(spark, turns).select("seq", "k"), str(checkpoint), printed, availableNow=True)
        query.awaitTermination()
        return [r.value for r in sinks.printed_lines(spark, printed).collect()]

    want = sorted(f"{r.seq},{'null' if r.k is None else r.k}" for r in numbers(spark).collect())
    assert sorted(run()) == want
    batches = sorted(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    assert len(batches) == 4
    for name in (f"{batches[-1]}", f".{batches[-1]}.crc"):
        (checkpoint / "commits" / name).unlink()
    assert sorted(run()) == want
    assert (checkpoint / "commits" / str(batches[-1])).exists()
    assert not list((tmp_path / "printed" / "_staged").iterdir())


def test_commit_of_a_half_done_batch_and_abort(tmp_path):
    writer = PrintWriter(str(tmp_path), ",", False)
    staged = tmp_path / "_staged"
    staged.mkdir()

    def stage(name):
        (staged / name).write_text(f"{name}\n")
        return Written(name, 1)

    (tmp_path / "batch=3").mkdir()
    (tmp_path / "batch=3" / "old.txt").write_text("from a commit that ended half way\n")
    writer.commit([stage("a"), None, stage("b")], 3)
    assert {p.name for p in (tmp_path / "batch=3").iterdir()} == {"a", "b", "_done"}
    writer.commit([stage("c")], 3)  # the batch again
    assert {p.name for p in (tmp_path / "batch=3").iterdir()} == {"a", "b", "_done"}
    writer.abort([stage("d"), None], 4)
    assert not list(staged.iterdir()) and not (tmp_path / "batch=4").exists()


def test_failed_tasks_leave_no_line(spark, turns, tmp_path):
    printed, flag = str(tmp_path / "printed"), tmp_path / "failed"

    def fail_once(batches):
        for part in batches:
            if not flag.exists() and (part["seq"] == 100).any():
                flag.write_text("")
                raise RuntimeError("lost")
            yield part

    rows_of = stream(spark, turns).select("seq").mapInPandas(fail_once, "seq bigint")
    for _ in range(2):  # a local session does not try a task again, so the query is
        try:
            sinks.print_stream(rows_of, str(tmp_path / "c"), printed, availableNow=True).awaitTermination()
        except Exception:
            assert flag.exists()
    assert sorted(int(r.value) for r in sinks.printed_lines(spark, printed).collect()) == list(range(200))


# --- random numbers -----------------------------------------------------------------------------


def drawn(spark, folder):
    return spark.read.parquet(f"{folder}/rows")


def run_for(spark, folder, seconds, instances=3):
    numbers_of = random_loops(spark, 1, 10, seed=5, instances=instances, delay_ms=20)
    query = (
        numbers_of.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="300 milliseconds")
        .start(f"{folder}/rows")
    )
    deadline = time.time() + 60
    while time.time() < deadline and sum(p["numInputRows"] for p in query.recentProgress) == 0:
        time.sleep(0.2)  # the first worker takes a while to start
    time.sleep(seconds)
    query.stop()


def test_random_loops_go_on_and_draw_the_same_again(spark, tmp_path):
    folder = str(tmp_path)
    run_for(spark, folder, 6)
    before = drawn(spark, folder).count()
    assert before > 0
    run_for(spark, folder, 6)  # the ticks between come too
    got = drawn(spark, folder).collect()
    ids = sorted(r.id for r in got)
    assert len(got) > before and ids == list(range(ids[0], ids[0] + len(ids)))  # nothing twice, nothing left out
    assert {r.instance for r in got} == {0, 1, 2} and all(r.id % 3 == r.instance for r in got)
    assert {r.v for r in got} == set(range(1, 11))
    column = spark.createDataFrame([(i,) for i in ids], "id long").select("id", sources.random_int(F.col("id"), 1, 10, 5).alias("v"))
    assert {(r.id, r.v) for r in got} == {(r.id, r.v) for r in column.collect()}
    # A batch that is run again from its logged offsets has the same rows.
    offsets = sorted((Path(folder) / "checkpoint" / "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    start, end = (json.loads(p.read_text().splitlines()[-1]) for p in offsets[:2])
    again = [(3 * t + i, draw(3 * t + i, 1, 10, 5)) for t in range(start["tick"], end["tick"]) for i in range(3)]
    assert set(again) <= {(r.id, r.v) for r in got}


def test_random_loops_feed_the_count_trigger(spark, tmp_path):
    source = random_loops(spark, instances=2, delay_ms=10)
    fired = count_trigger_stream(source, "ts", 3600, "v", 5, ["id"])
    out = str(tmp_path / "rows")
    query = (
        fired.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start(out)
    )
    deadline = time.time() + 60
    while time.time() < deadline and sum(p["numInputRows"] for p in query.recentProgress) < 500:
        time.sleep(0.5)
    query.stop()
    sums = spark.read.parquet(out).where("kind = 'sum'").collect()
    assert sums and all(r.n == 5 and 5 <= r.total <= 50 for r in sums)


def test_random_loops_refuse_nonsense(spark):
    with pytest.raises(Exception, match="low <= high"):
        random_loops(spark, 5, 4).writeStream.format("noop").start().awaitTermination(30)


def test_pandas_is_what_user_code_sees():
    merged = code("k")["merge"](pd.DataFrame({"k": [1, 1], "n": [1, 2], "low": [3.0, None], "digits": ["1", "0"]}))
    assert merged.to_dict("records") == [{"k": 1, "n": 3, "low": 3.0, "digits": "01"}]
