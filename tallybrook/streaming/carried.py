"""Ordered per-key results of streams by the batch operators, with totals carried between batches.

Each batch is one distributed job: the totals of earlier batches join in as one leading row per key,
the scan of ``operators.scan`` splits hot keys and single sequences over tasks, and all of it is built-in
code. So a batch may be large and one key may hold most of it. Each batch reads and rewrites the
carried table (one row per key), so batches should be large beside it; for small frequent batches
over many keys use ``streaming.ordered``.

A row that arrives in a later batch counts as later, whatever its order. ``order`` must be unique
within a key. After a failure a batch runs again and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.times import epoch_micros, seconds_interval
from tallybrook.operators import running
from tallybrook.operators.scan import prefix_scan
from tallybrook.operators.windows import with_window
from tallybrook.session import shared_folder

# Batch b reads slot b-1 and writes slot b, modulo this; a rerun of b finds its input untouched.
SLOTS = 3

Step = Callable[[DataFrame, DataFrame | None], DataFrame]


def replay_carried(stream: DataFrame, step: Step, carry: Step, folder: str | None = None, **trigger) -> DataFrame:
    """Run ``stream`` batch by batch and return all rows written.

    ``step(batch, carried)`` gives the batch's output rows and ``carry(rows, carried)`` the table
    carried on; ``carried`` is None in the first batch. Called again with the same ``folder`` the
    stream goes on where it stopped. Default trigger: all input there is now.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "carried")

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        carried = (
            session.read.parquet(f"{folder}/carried/slot={(number - 1) % SLOTS}") if number else None
        )
        out = f"{folder}/rows/batch={number}"
        step(batch, carried).write.mode("overwrite").parquet(out)
        following = carry(session.read.parquet(out), carried)
        following.write.mode("overwrite").parquet(f"{folder}/carried/slot={number % SLOTS}")

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()
    return spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").drop("batch")


def _with_past(batch: DataFrame, carried: DataFrame | None, **values: str) -> DataFrame:
    """The batch's rows and one leading row per carried key; ``_live`` is 1 for the batch's.

    ``values`` maps each scanned column to the carried column that it continues.
    """
    live = batch.withColumn("_live", F.lit(1))
    if carried is None:
        return live
    renamed = {total: value for value, total in values.items()}
    past = carried.select(*[F.col(c).alias(renamed.get(c, c)) for c in carried.columns])
    return live.unionByName(past.withColumn("_live", F.lit(0)), allowMissingColumns=True)


def _newest(rows: DataFrame, carried: DataFrame | None, keys: Sequence[str], order: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Per key the totals of its last row, or else those carried so far."""
    live = rows.select(*keys, F.struct(F.lit(1), *order).alias("_at"), *totals)
    newest = live.groupBy(*keys).agg(F.max_by(F.struct(*totals), "_at").alias("_t"))
    newest = newest.select(*keys, *[F.col(f"_t.{t}").alias(t) for t in totals])
    if not keys:
        newest = newest.where(F.col(totals[0]).isNotNull())
    if carried is None:
        return newest
    both = newest.withColumn("_new", F.lit(1)).unionByName(carried.withColumn("_new", F.lit(0)))
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*totals), "_new").alias("_t"))
    return last.select(*keys, *[F.col(f"_t.{t}").alias(t) for t in totals])


def _total_type(column: T.DataType) -> T.DataType:
    """A type for sums that stays the same from batch to batch."""
    if isinstance(column, T.DecimalType):
        return T.DecimalType(38, column.scale)
    return T.LongType() if isinstance(column, T.IntegralType) else T.DoubleType()


def running_carried(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str | None = None, folder: str | None = None, **scan
) -> DataFrame:
    """Every change of a key's count and total: ``*keys, *order, amount, n, total``.

    ``amount`` may be of any numeric type; a decimal or integer gives exact totals. Without it only
    ``n``.
    """
    names = list(dict.fromkeys([*keys, *order, *([amount] if amount else [])]))
    totals = ["n", "total"] if amount else ["n"]
    total_type = _total_type(stream.schema[amount].dataType) if amount else None

    def step(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
        live = batch.select(*names).withColumn("_one", F.lit(1).cast("bigint"))
        if amount:
            live = live.withColumn("_amount", F.col(amount).cast(total_type))
        rows = _with_past(live, carried, _one="n", **({"_amount": "total"} if amount else {}))
        outputs = {"n": ("sum", F.col("_one"))}
        if amount:
            outputs["total"] = ("sum", F.col("_amount"))
        scanned = prefix_scan(rows, keys, ["_live", *order], outputs, **scan).where("_live = 1")
        if amount:
            scanned = scanned.withColumn("total", F.col("total").cast(total_type))
        return scanned.select(*names, *totals)

    def carry(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        return _newest(rows, carried, keys, order, totals)

    return replay_carried(stream, step, carry, folder)


def flag_small_then_large_carried(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    *,
    small: float,
    large: float,
    ts: str | None = None,
    max_gap_seconds: float | None = None,
    folder: str | None = None,
    **scan,
) -> DataFrame:
    """Twin of ``running.flag_small_then_large``: ``*keys, *order, amount, flagged``."""
    names = list(dict.fromkeys([*keys, *order, amount]))

    def step(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
        us = epoch_micros(batch, ts) if ts else F.lit(None).cast("bigint")
        live = batch.select(*names, us.alias("us"), F.col(amount).alias("_last"))
        rows = _with_past(live, carried, _last="last")
        previous = prefix_scan(
            rows,
            keys,
            ["_live", *order],
            {"_prev": ("last", F.col("_last")), "_prev_us": ("last", F.col("us"))},
            include_current=False,
            **scan,
        ).where("_live = 1")
        rule = (F.col(amount) > large) & (F.col("_prev") < small)
        if max_gap_seconds is not None:
            rule &= F.col("us") - F.col("_prev_us") <= int(max_gap_seconds * 1_000_000)
        return previous.select(
            *names, "us", F.col(amount).alias("last"), F.coalesce(rule, F.lit(False)).alias("flagged")
        )

    def carry(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        return _newest(rows, carried, keys, order, ["last", "us"])

    return replay_carried(stream, step, carry, folder).select(*names, "flagged")


def split_late_carried(
    stream: DataFrame,
    ts: str,
    order: Sequence[str],
    seconds: int,
    *,
    delay_seconds: int = 0,
    lateness_seconds: int = 0,
    keys: Sequence[str] = (),
    folder: str | None = None,
    **scan,
) -> DataFrame:
    """Twin of ``late.split_late``, for one arrival sequence (``keys=()``) or one per key.

    All columns of the stream and ``prior_max_ts, window_start, window_end, is_late``.
    """

    def step(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
        rows = _with_past(batch.withColumn("_seen", F.col(ts)), carried, _seen="largest")
        marked = prefix_scan(
            rows,
            keys,
            ["_live", *order],
            {"prior_max_ts": ("max", F.col("_seen"))},
            include_current=False,
            **scan,
        ).where("_live = 1")
        closed = F.col("window_end") + seconds_interval(delay_seconds + lateness_seconds)
        return (
            with_window(marked, ts, seconds)
            .withColumn("is_late", F.coalesce(F.col("prior_max_ts") >= closed, F.lit(False)))
            .drop("_live", "_seen")
        )

    def carry(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        seen = rows.select(*keys, F.col(ts).alias("largest"))
        both = seen if carried is None else seen.unionByName(carried)
        return both.groupBy(*keys).agg(F.max("largest").alias("largest"))

    return replay_carried(stream, step, carry, folder)


def top_k_carried(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, k: int, folder: str | None = None
) -> DataFrame:
    """Rows that are among their key's ``k`` largest after their batch: ``*keys, *order, amount, rank``.

    Ranked as by ``running.top_k``: nulls last, ties by ``order``. The final top k are among them. The k rows of
    each key are carried, and tasks keep only k rows of a key before the shuffle.
    """
    names = list(dict.fromkeys([*keys, *order, amount]))
    best = [F.col(amount).desc(), *map(F.col, order)]

    def step(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
        rows = batch.select(*names)
        return running.top_k(rows if carried is None else rows.unionByName(carried), keys, best, k)

    def carry(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        return rows.select(*names)  # carried keys without new rows are among them

    return replay_carried(stream, step, carry, folder)


def count_trigger_carried(
    stream: DataFrame,
    ts: str,
    seconds: int,
    value: str,
    k: int,
    order: Sequence[str],
    *,
    keys: Sequence[str] = (),
    echo: bool = False,
    emit_remainder: bool = False,
    expire_seconds: int | None = None,
    folder: str | None = None,
    **scan,
) -> DataFrame:
    """Twin of ``count_trigger.count_trigger_sums``: ``window_start, window_end, *keys, firing, total, n``.

    A firing comes out in the batch that brings its k-th row. With ``echo`` there is a first column
    ``kind``: ``sum``, or ``input`` for each row with its firing, its value and 1. With
    ``emit_remainder`` the rows after a window's last firing come out too, as many as have come by the
    last batch. A batch writes only groups that have rows in it. The carried table keeps a row for each
    window and key; windows that ended ``expire_seconds`` before the latest one are dropped from it, and
    rows that still come for them start the window anew.
    """
    group = ["window_start", "window_end", *keys]
    total_type = _total_type(stream.schema[value].dataType)

    def step(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
        needed = batch.select(*dict.fromkeys([*keys, ts, value, *order]))
        live = with_window(needed, ts, seconds).select(
            *group, *order, F.col(value).cast(total_type).alias("_v"), F.lit(1).cast("bigint").alias("_one")
        )
        if carried is not None:
            # Only what goes on in this batch joins in.
            here = live.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]).distinct()
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)])
            carried = carried.join(here, same, "left_semi")
        rows = _with_past(live, carried, _one="seen", _v="open_total")
        numbered = prefix_scan(rows, group, ["_live", *order], {"_rn": ("sum", F.col("_one"))}, **scan)
        # A carried row stands for the `seen % k` rows of the firing that is still open.
        is_past = F.col("_live") == 0
        firing = F.when(is_past, F.call_function("div", F.col("_rn"), F.lit(k))).otherwise(
            F.call_function("div", F.col("_rn") - 1, F.lit(k))
        )
        placed = numbered.select(
            *group,
            "_live",
            firing.alias("firing"),
            "_v",
            F.when(is_past, F.pmod("_rn", F.lit(k))).otherwise(F.lit(1)).alias("_n"),
        )
        sums = placed.groupBy(*group, "firing").agg(F.sum("_v").cast(total_type).alias("total"), F.sum("_n").alias("n"))
        out = sums.where("n > 0").select(F.lit("sum").alias("kind"), *group, "firing", "total", "n")
        if echo:
            inputs = placed.where("_live = 1").select(
                F.lit("input").alias("kind"), *group, "firing", F.col("_v").alias("total"), F.lit(1).cast("bigint").alias("n")
            )
            out = out.unionByName(inputs)
        return out

    def carry(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
        last = rows.where("kind = 'sum'").groupBy(*group).agg(F.max_by(F.struct("firing", "total", "n"), "firing").alias("_t"))
        new = last.select(
            *group,
            (F.col("_t.firing") * k + F.col("_t.n")).alias("seen"),
            F.when(F.col("_t.n") < k, F.col("_t.total")).cast(total_type).alias("open_total"),
        )
        both = new if carried is None else new.unionByName(carried)
        # Of a group in both, the new one has seen more.
        kept = both.groupBy(*group).agg(F.max_by(F.struct("seen", "open_total"), "seen").alias("_t"))
        kept = kept.select(*group, "_t.seen", "_t.open_total")
        if expire_seconds is None:
            return kept
        latest = both.agg(F.max("window_end")).first()[0]
        return kept if latest is None else kept.where(F.col("window_end") + seconds_interval(expire_seconds) >= F.lit(latest))

    rows = replay_carried(stream, step, carry, folder)
    whole = rows.where((F.col("n") == k) | (F.col("kind") == "input"))
    if emit_remainder:
        # What is left of a window is its last firing, in the batch that had most of it.
        last = rows.where("kind = 'sum'").groupBy(*group, "firing").agg(F.max_by(F.struct("total", "n"), "n").alias("_t"))
        rest = last.where(F.col("_t.n") < k).select(F.lit("sum").alias("kind"), *group, "firing", "_t.total", "_t.n")
        whole = whole.unionByName(rest)
    return whole if echo else whole.drop("kind")
