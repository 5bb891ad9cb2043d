"""Token counts of the documents in flat token files, which have no index: a scan for end ids.

A flat file is one unsigned 16-bit little-endian id after the other, an end id after each document. It
is read in blocks of equal size, as many at once as there are tasks. A block's end ids are found with
one vectorised comparison; a prefix scan over the blocks of a file then says how many documents ended
before each block, and where the document began that goes on into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import chunks, materialize
from tallybrook.llm.tokens import default_vocabulary, encode
from tallybrook.session import shared_folder

ID_BYTES = 2  # vocabularies of up to 65,536 ids
ID = "<u2"
END_ID = 50256


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One flat file for each task below ``folder``; returns (file, ordinal, doc_id), written already.

    A task writes under a name of its own attempt and renames the whole file, so a repeated task
    leaves the same file. ``folder`` must be seen by all executors. A null text is an empty document.
    """
    path = vocabulary or default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"tokens-{context.partitionId():06d}.bin"
        store, root = _at(folder)
        store.create_dir(root, recursive=True)
        attempt = f"{root}/_attempt-{context.taskAttemptId()}-{name}"
        ordinal = 0
        with store.open_output_stream(attempt) as out:
            for whole in batches:
                for batch in chunks(whole, "text"):
                    for text in batch.column("text"):
                        out.write(np.append(encode(text.as_py(), path), np.uint32(end_id)).astype(ID).tobytes())
                    n = batch.num_rows
                    places = np.arange(ordinal, ordinal + n, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n, pa.string()), pa.array(places), batch.column("doc_id")],
                        names=["file", "ordinal", "doc_id"],
                    )
                    ordinal += n
        store.move(attempt, f"{root}/{name}")

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(write, "file string, ordinal long, doc_id long"), "token-order")


def count_tokens(spark: SparkSession, folder: str, end_id: int = END_ID, block_bytes: int = 4 << 20) -> DataFrame:
    """One row for each document of the flat files in ``folder``: file, ordinal, start, n_tokens, ended.

    ``n_tokens`` leaves out the end id. Tokens after the last end id are a document with ``ended``
    false. Two end ids in a row hold an empty document. An empty file has none. Bytes that do not make
    up a whole id are left out. Names that begin with ``_`` are not read.
    """
    if block_bytes % ID_BYTES:
        raise ValueError("a block must hold whole ids")
    files = spark.read.format("binaryFile").load(folder).select("path", "length")  # contents are not read here
    per = block_bytes
    listed = (
        files.where(F.col("length") >= ID_BYTES)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / per))))
        .repartition(F.xxhash64("path", "block"))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "block"))):
                store, name = _at(path)
                begin, whole = block * per, length // ID_BYTES
                with store.open_input_file(name) as source:
                    data = source.read_at(min(per, whole * ID_BYTES - begin), begin)
                ids = np.frombuffer(data, ID)
                first = begin // ID_BYTES
                ends = np.flatnonzero(ids == end_id) + first
                is_open = first + len(ids) == whole and len(ids) and ids[-1] != end_id
                if is_open:  # the file's end closes it
                    ends = np.append(ends, whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.rpartition("/")[2]]), pa.array([block], pa.int64()),
                        pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([bool(is_open)]),
                    ],
                    names=["file", "block", "ends", "is_open"],
                )

    schema = "file string, block long, ends array<bigint>, is_open boolean"
    blocks = materialize(listed.mapInArrow(scan, schema), "blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Two numbers a block are scanned, not its documents.
    scanned = blocks.select("file", "block", F.size("ends").alias("n"), F.array_max("ends").alias("last")).select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("carried"),
    )
    last = F.col("at") == F.size("ends") - 1
    return (
        blocks.join(scanned, ["file", "block"])
        .select("*", F.posexplode("ends").alias("at", "end"))
        .withColumn(
            "start", 1 + F.when(F.col("at") == 0, F.col("carried")).otherwise(F.expr("ends[at - 1]"))
        )
        .select(
            "file",
            (F.col("before") + F.col("at")).alias("ordinal"),
            "start",
            (F.col("end") - F.col("start")).alias("n_tokens"),
            (~(last & F.col("is_open"))).alias("ended"),
        )
    )


def document_token_counts(docs: DataFrame, vocabulary: str | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """doc_id and n_tokens of each row of ``docs``, by way of flat files in the shared folder.

    Null and empty texts have 0 tokens; repeated rows and null ids keep a row each.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    order = write_token_files(docs, folder, vocabulary)
    if order.isEmpty():
        return spark.createDataFrame([], "doc_id long, n_tokens long")
    counted = count_tokens(spark, folder, block_bytes=block_bytes)
    return order.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
