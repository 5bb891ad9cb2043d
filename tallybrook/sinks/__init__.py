"""Outputs: delimited text, printed lines, several sinks on one stream, and replays into a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook import sources
from tallybrook.session import rocksdb_state, shared_folder
from tallybrook.sinks.printing import Printed


def write_delimited(df: DataFrame, path: str, *, sep: str = " ", mode: str = "errorifexists") -> None:
    """Text files of ``sep``-delimited fields, without header; fails if ``path`` exists already."""
    df.write.mode(mode).option("sep", sep).option("header", False).csv(path)


def print_stream(
    df: DataFrame,
    checkpoint: str,
    folder: str | None = None,
    *,
    mode: str = "append",
    name: str | None = None,
    sep: str = ",",
    echo: bool = False,
    **trigger,
) -> StreamingQuery:
    """Print every row of every batch as a line, in the tasks that have the rows; no row passes the driver.

    The lines are in ``folder`` (default: ``printed`` below the checkpoint), which all executors must see, below ``batch=<number>``: each row once, also if a
    batch is run again (see ``sinks.printing``). With ``echo`` tasks also print them, with their partition's
    number in front, to their own output, where lines of a failed attempt stay. Default trigger: as fast as rows come.
    """
    df.sparkSession.dataSource.register(Printed)
    writer = df.writeStream.format(Printed.name()).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.option("folder", folder or f"{checkpoint.rstrip('/')}/printed").option("sep", sep).option("echo", str(echo).lower())
    if name:
        writer = writer.queryName(name)
    with rocksdb_state(df.sparkSession):
        return (writer.trigger(**trigger) if trigger else writer).start()


def printed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``batch`` and ``value`` of what :func:`print_stream` has printed to ``folder`` and committed."""
    return spark.read.schema("value string, batch bigint").option("basePath", folder).text(f"{folder}/batch=*")


def fan_out(
    stream: DataFrame, writers: Sequence[Callable[[DataFrame, int], None]], checkpoint: str, **trigger
) -> StreamingQuery:
    """Give each batch of one stream to several writers, reading and computing it once.

    A batch may be given again after a failure; a writer should use the batch number to make its
    write repeatable.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, number)
        finally:
            batch.unpersist()

    with rocksdb_state(stream.sparkSession):
        return (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def replay_slices(
    df: DataFrame, by: str, replay: Callable[[DataFrame, str], DataFrame], slices: int = 4, ts: str | None = None
) -> DataFrame:
    """Give a table to a stream slice by slice, in the order of ``by``, and return what ``replay`` last returned.

    ``replay(stream, folder)`` runs the stream over what is there now and goes on where it stopped in that
    folder, as all replays here do. Each slice is one batch, whatever its size and however many files it
    has, and rows with equal ``by`` are never parted. Nulls come first.
    """
    spark = df.sparkSession
    position = F.unix_micros(F.col(by).cast("timestamp")) if dict(df.dtypes)[by].startswith("timestamp") else F.col(by)
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    bounds = df.agg(F.percentile_approx(position, shares).alias("b")).first()["b"] or []
    edges = [None, *bounds, None]
    folder = shared_folder(spark, "slices")
    rows = None
    for low, high in zip(edges, edges[1:]):
        # Nulls are in the first slice only.
        after = F.lit(True) if low is None else position > low
        until = F.lit(True) if high is None else (position <= high) | (position.isNull() & F.lit(low is None))
        df.where(after & until).write.mode("append").parquet(f"{folder}/in")
        rows = replay(sources.table_stream(spark, f"{folder}/in", ts), f"{folder}/replay")
    return rows


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a replay's folder, once nothing reads its rows any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def replay_append(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream over all input there is now, in append mode, and return what it wrote.

    Output and checkpoint lie in ``folder``, by default a new one in the shared folder. Called again
    with the same folder, the stream goes on where it stopped.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "replay")
    with rocksdb_state(spark):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/rows")
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def replay_update(stream: DataFrame, keys: Sequence[str], folder: str | None = None) -> DataFrame:
    """Run a stream in update mode over all input there is now and return each key's last row.

    Every batch writes its changes to a folder of its own, replaced if the batch is run again.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "replay")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    with rocksdb_state(spark):
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    changes = spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    values = [c for c in stream.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch").alias("_last"))
        .select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
    )

