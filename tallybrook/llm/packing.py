"""Pack token pieces into sequences: best-fit decreasing, certified by dual-feasible lower bounds.

The pieces are dealt to groups of bounded size and each group is packed by best-fit decreasing. A
lower bound from dual-feasible functions certifies a group whose number of sequences equals it.
Groups with a gap give up the documents of sequences that are not full, certified ones those of sequences that are
not half full; these are dealt anew to fewer groups and packed again, and what saves sequences is kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import chunks, groups_of, materialize
from tallybrook.llm.tokens import default_vocabulary, encode

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED = PIECES + ", sequence_id long, offset long, gap long"


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Each document as pieces of at most ``capacity`` tokens, ``end_id`` after its last token.

    Only longer documents are cut; all their pieces but the first are full. A null text is empty, so
    it is the end id alone. A special token's string in a text is its id, as by the vocabulary's own settings. Repeated rows and repeated or null ids give pieces of their own. ``deal``
    numbers the pieces of a task, so that copies spread evenly over groups.
    """
    path = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = 0
        for whole in batches:
            for batch in chunks(whole, "text"):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    ids = np.append(encode(text.as_py(), path, special=True), np.uint32(end_id)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), dealt))
                        dealt += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32())]
    + [(name, pa.int64()) for name in ("start", "length", "ids_crc32", "deal")]
)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """No packing of ``sizes`` needs fewer bins. The largest of three families of dual-feasible sums.

    Each function maps sizes to numbers whose sum over any bin is at most one, so the sum over all
    sizes, rounded up, is a bound: the size itself; sizes above ``capacity - cut`` as a whole bin and
    those below ``cut`` as nothing; and sizes rounded down to k-ths, but for exact multiples.
    """
    count = np.bincount(np.asarray(sizes, np.int64), minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for cut in range(1, capacity // 2 + 1):
        value = np.where(size > capacity - cut, capacity, np.where(size < cut, 0, size))
        best = max(best, -(-int((count * value).sum()) // capacity))
    for k in range(1, 33):
        scaled = size * (k + 1)
        whole = scaled % capacity == 0
        # In units of 1 / (capacity * k), so that the sum is exact.
        value = np.where(whole, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and the place in it of each size, and the number of bins."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    full = int((sizes >= capacity).sum())
    bins[order[:full]], offsets[order[:full]] = np.arange(full), 0
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by what is left in them
    left, opened = 0, full  # bit r of ``left``: a bin with r left is open
    for at in order[full:].tolist():
        size = int(sizes[at])
        fitting = left >> size
        if fitting:
            rest = size + (fitting & -fitting).bit_length() - 1
            own = free[rest].pop()
            if not free[rest]:
                left &= ~(1 << rest)
        else:
            rest, own = capacity, opened
            opened += 1
        bins[at], offsets[at] = own, capacity - rest
        rest -= size
        if rest:
            free[rest].append(own)
            left |= 1 << rest
    return bins, offsets, opened


def _packed(pieces: DataFrame, groups: int, capacity: int, turn: int) -> DataFrame:
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["length"].to_numpy()
        bins, offsets, used = best_fit(sizes, capacity)
        waste = capacity - np.bincount(bins, weights=sizes, minlength=used)
        gap = used - lower_bound(sizes, capacity)
        # The gap stays with the pieces that are to be dealt again: those of sequences that are not full.
        # A certified group gives up what is less than half full: what single groups must leave open, several can fill.
        again = np.where(waste[bins] > (0 if gap else capacity // 2), max(gap, 1), 0).astype(np.int64)
        names = (np.int64(turn) << 56) + (np.int64(key[0]) << 28) + bins
        return rows.drop(columns="bucket").assign(sequence_id=names, offset=offsets, gap=again)

    bucket = F.pmod(F.xxhash64("deal", F.lit(turn), *([] if turn else ["ids_crc32"])), F.lit(groups))
    return pieces.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(pack, PACKED)


def pack(pieces: DataFrame, capacity: int = 1024, rows_per_group: int = 16384, turns: int = 4) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no two overlap and a sequence has no holes.

    ``pieces`` has the columns of :func:`token_pieces`. A group has about ``rows_per_group`` pieces, so
    a task's memory does not grow with the table. At most ``turns`` exchanges follow the first packing,
    and each is kept only if it needs fewer sequences. An empty table gives no rows.
    """
    pieces = materialize(pieces, "pieces")
    done, open_rows = [], pieces
    total = pieces.count()
    before = None
    for turn in range(turns + 1):
        new = materialize(_packed(open_rows, groups_of(total, rows_per_group), capacity, turn), "packed")
        figures = new.agg(
            F.count_if((F.col("offset") == 0) & (F.col("gap") > 0)).alias("open"),
            F.count_if(F.col("gap") > 0).alias("rows"),
            F.count_if(F.col("offset") == 0).alias("bins"),
        ).first()
        if before is not None:
            if figures["bins"] >= before[1]:  # nothing is gained: another turn deals the same pieces in another way
                if turn == turns:
                    done.append(before[0])
                continue
        done.append(new.where("gap = 0"))
        before = (new.where("gap > 0"), figures["open"])
        if not figures["rows"] or turn == turns or (turn and groups_of(total, rows_per_group) == 1):
            done.append(before[0])
            break
        total = figures["rows"]
        open_rows = before[0].select(pieces.columns)
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    return packed.drop("deal", "gap")
