"""Repeats of a fixed length across documents: what byte and word windows have in common.

A window is a fixed number of consecutive units (bytes or words) of one document. A rule that looks at
the window's content alone picks an anchor inside each window. Consecutive windows of a document with
the same anchor make a segment: a row with the hash of the anchor and the hash of all its units. Two
equal windows pick equal anchors at the same place, so:

* a segment whose anchor occurs once has no repeated window;
* segments of equal anchor and content repeat each other, however many they are;
* only segments that share an anchor with other content are open, and their units are looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import chunks, materialize

SEGMENT = "doc long, text_key long, anchor long, content long, low int, high int"
RANGE = ["doc", "text_key", "low", "high"]
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """doc (the id; a number of its own for null), text_key and text (null: empty).

    Rows of the same id are told apart by their text; rows that repeat both have the same repeats.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )


def segments(docs: DataFrame, find: Callable) -> DataFrame:
    """Rows of SEGMENT for ``docs`` as from :func:`keyed`; written already.

    ``find(texts)`` gives arrays: row of the text, anchor, content, first and last window.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                row, anchor, content, low, high = find(batch.column("text"))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(at), batch.column("text_key").take(at),
                        pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                        pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                    ],
                    names=["doc", "text_key", "anchor", "content", "low", "high"],
                )

    return materialize(docs.mapInArrow(scan, SEGMENT), "segments")


def settle(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranges of windows that are repeated, open segments).

    An open segment is one of each content, with ``copies`` of it; only where that is 1 are its windows
    still to be decided. Counts are combined in the tasks before they are shuffled.
    """
    anchors = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("content").alias("one"), F.max("content").alias("two"))
        .where("n > 1")
        .select("anchor", (F.col("one") == F.col("two")).alias("same"))
    )
    shared = materialize(found.join(anchors, "anchor"), "shared")
    mixed = shared.where("NOT same")
    contents = materialize(
        mixed.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(F.struct(*RANGE)).alias("of")), "contents"
    )
    repeated = shared.where("same").select(RANGE).unionAll(
        mixed.join(contents.where("copies > 1").select("anchor", "content"), ["anchor", "content"]).select(RANGE)
    )
    return repeated, contents.select("anchor", "content", "copies", "of.*")


def first_per_window(starts: np.ndarray, anchors: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where a new segment begins among windows given by start, anchor and text, in order."""
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1]) | (starts[1:] != starts[:-1] + 1)
    return np.flatnonzero(new)


def by_document(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``docs`` with ``found``: their different ranges, an array of (low, high), null without any."""
    own = ranges.groupBy("doc", "text_key").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    return docs.join(own, ["doc", "text_key"], "left")


def covered(found: list[dict] | None, length: int, units: int) -> np.ndarray:
    """Which of ``units`` units lie in a window of ``length`` units that starts in one of the ranges."""
    step = np.zeros(units + 1, np.int64)
    for r in found or ():
        step[r["low"]] += 1
        step[r["high"] + length] -= 1
    return np.cumsum(step[:-1]) > 0
