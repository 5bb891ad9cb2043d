"""Remove byte strings that occur more than once in a corpus, with suffix arrays.

Segments of 400-byte windows (see :mod:`repeats`) are anchored at the least hash of 32 bytes inside a
window. What is open after counting is dealt to shards of bounded size. Each shard sorts its suffixes by
Larsson and Sadakane's refinement and gets the common prefixes of neighbours by Kasai's rule; windows
whose common prefix is a whole window repeat. An anchor with more text than a shard holds is dealt to
several, which then merge the sorted fingerprints of their windows by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm import repeats
from tallybrook.llm.common import chunks, groups_of, materialize, text_bytes
from tallybrook.llm.words import mix

GRAM = 32
BLOCK = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _TABLES.get("n", 0) < n:
        _TABLES.update(n=n, up=_powers(_BASE, n), down=_powers(_INVERSE, n))
    return _TABLES["up"], _TABLES["down"]


def gram_hashes(raw: np.ndarray, n: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive bytes."""
    up, down = _tables(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[: len(raw)], dtype=np.uint64)))
    return mix((total[n:] - total[:-n]) * down[: len(raw) - n + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def window_segments(length: int):
    """``find`` for :func:`repeats.segments` over windows of ``length`` bytes."""
    inside = length - GRAM + 1  # grams of a window

    def find(texts: pa.Array):
        raw, bounds = text_bytes(texts)
        parts: list[tuple] = []
        # A long text is cut into blocks of windows, which overlap by a window of bytes.
        at = 0
        while at + length <= len(raw):
            part = raw[at : at + BLOCK + length - 1]
            hashes = gram_hashes(part)
            packed = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
            place = (sliding_least(packed, inside) & np.uint64((1 << 24) - 1)).astype(np.int64)
            starts = np.arange(len(place)) + at
            row = np.searchsorted(bounds, starts, "right") - 1
            whole = starts + length <= bounds[row + 1]
            starts, place, row = starts[whole], place[whole] + at, row[whole]
            first = repeats.first_per_window(starts, place, row)
            last = np.append(first[1:], len(starts)) - 1 if len(first) else first
            parts.append((row[first], place[first], starts[first], starts[last]))
            at += BLOCK
        row, place, low, high = (np.concatenate(c) if parts else np.empty(0, np.int64) for c in (zip(*parts) if parts else ((),) * 4))
        view = memoryview(raw)
        digest = xxhash.xxh3_64_intdigest
        anchor = np.fromiter((digest(view[p : p + GRAM]) for p in place.tolist()), np.uint64, len(place))
        content = np.fromiter(
            (digest(view[a : b + length], p - a) for a, b, p in zip(low.tolist(), high.tolist(), place.tolist())),
            np.uint64,
            len(place),
        )
        begin = bounds[row]
        return row, anchor, content, low - begin, high - begin

    return find


def _leading(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each place as a number, zeros after the piece's end."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    key = np.zeros(len(text), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(left > k, padded[k : k + len(text)], 0).astype(np.uint64)
    return key


def suffix_array(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes or more. ``ends`` says where each one's piece ends.

    Groups of suffixes that agree so far are refined by the ranks of what follows, with twice as many
    bytes each time; a suffix alone in its group is done.
    """
    n = len(text)
    where = np.arange(n)
    left = ends - where
    key = _leading(text, left)
    order = np.lexsort((np.minimum(left, 8), key))
    new = np.ones(n, bool)
    # Suffixes of fewer than 8 bytes end here: each is a group of its own.
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < 8) | (left[order[:-1]] < 8)
    head = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))  # places of groups with more than one
    done = 8
    while len(slots) and done < depth:
        at = order[slots]
        after = at + done
        follows = np.where(after < ends[at], rank[np.minimum(after, n - 1)] + n, at)  # ended ones differ
        group = rank[at]
        sort = np.argsort(group * (2 * n) + follows)
        at, follows, group = at[sort], follows[sort], group[sort]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])
        head = np.flatnonzero(new)
        rank[at] = np.repeat(slots[head], np.diff(np.append(head, len(slots))))
        slots = slots[~(new & np.append(new[1:], True))]
        done *= 2
    return order


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By place of the text: the common prefix of its suffix and the one before that in order.

    From one place to the next the value falls by one where both suffixes go on from their neighbours
    (Kasai's rule). Only at the other places are bytes compared, eight at a time.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    where = np.arange(n)
    left = ends - where
    key = _leading(text, left)
    paired = before >= 0
    goes_on = np.zeros(n, bool)
    goes_on[1:] = (
        paired[1:] & paired[:-1] & (before[1:] == before[:-1] + 1) & (ends[1:] == ends[:-1])
        & (ends[before[1:]] == ends[before[:-1]]) & (text[:-1] == text[before[:-1]])
    )
    value = np.zeros(n, np.int64)
    live = np.flatnonzero(paired & ~goes_on)
    while len(live):
        a, b = live + value[live], before[live] + value[live]
        inside = (a < ends[live]) & (b < ends[before[live]])
        live, a, b = live[inside], a[inside], b[inside]
        differ = key[a] ^ key[b]
        equal = np.zeros(len(live), np.int64)
        for k in range(8):
            equal += (differ >> np.uint64(56 - 8 * k)) == 0
        equal = np.minimum(equal, np.minimum(left[a], left[b]))
        value[live] += equal
        live = live[equal == 8]
    last = np.maximum.accumulate(np.where(goes_on, 0, where))
    return value[last] - (where - last)


def repeated_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the pieces in their order: piece, place in it, and whether it is equal to the one before."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    text = np.frombuffer(b"".join(pieces), np.uint8)
    stops = np.cumsum(sizes)
    ends = np.repeat(stops, sizes)
    order = suffix_array(text, ends, length)
    shared = common_prefixes(text, ends, order)[order] >= length
    whole = ends[order] - order >= length
    order, shared = order[whole], shared[whole]
    piece = np.searchsorted(stops, order, "right")
    return piece, order - (stops - sizes)[piece], shared


def _ranges(places: np.ndarray) -> list[tuple[int, int]]:
    """Sorted different numbers as runs of consecutive ones."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist()))


PIECE = "anchor long, known boolean, doc long, text_key long, low int, piece binary"
FOUND = "doc long, text_key long, low int, high int, prints binary, known boolean"


def _pieces(docs: DataFrame, open_segments: DataFrame, length: int) -> DataFrame:
    """The bytes of open segments, from one more pass over the texts that have any."""
    wanted = open_segments.groupBy("doc", "text_key").agg(
        F.collect_set(F.struct("anchor", (F.col("copies") > 1).alias("known"), "low", "high")).alias("cut")
    )
    here = docs.join(wanted, ["doc", "text_key"]).dropDuplicates(["doc", "text_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                raw, bounds = text_bytes(batch.column("text"))
                view, rows = memoryview(raw), []
                for i, (doc, key, cuts) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in ("doc", "text_key", "cut")))
                ):
                    for c in cuts:
                        a, b = bounds[i] + c["low"], bounds[i] + c["high"] + length
                        rows.append((c["anchor"], c["known"], doc, key, c["low"], bytes(view[a:b])))
                types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                    names=["anchor", "known", "doc", "text_key", "low", "piece"],
                )

    return here.select("doc", "text_key", "text", "cut").mapInArrow(cut, PIECE)


def repeated_ranges(docs: DataFrame, length: int, shard_bytes: int = 2 << 20) -> DataFrame:
    """doc, text_key, low, high: the first bytes of windows that occur more than once in ``docs``."""
    repeated, open_segments = repeats.settle(repeats.segments(docs, window_segments(length)))
    sizes = open_segments.groupBy("anchor").agg(
        F.sum(F.col("high") - F.col("low") + F.lit(length).cast("long")).alias("bytes")
    )
    pieces = _pieces(docs, open_segments, length)
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = groups_of(total, shard_bytes)
    # An anchor with more than a shard's bytes goes to shards of its own, dealt by what the piece holds.
    parts = F.ceil(F.col("bytes") / shard_bytes).cast("long")
    big = sizes.where(F.col("bytes") > shard_bytes).select("anchor", parts.alias("parts"))
    dealt = pieces.join(big, "anchor", "left").select(
        "known", "doc", "text_key", "low", "piece",
        F.col("parts").isNotNull().alias("split"),
        F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .otherwise(F.xxhash64("anchor", F.pmod(F.xxhash64("piece"), "parts"))).alias("shard"),
    )

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts, known = rows["piece"].tolist(), rows["known"].to_numpy(bool)
        split, low = rows["split"].to_numpy(bool), rows["low"].to_numpy()
        piece, place, shared = repeated_windows(texts, length)
        if not len(piece):
            return pd.DataFrame(columns=["doc", "text_key", "low", "high", "prints", "known"])
        group = np.cumsum(~shared) - 1
        size = np.bincount(group)
        out = []
        docs_at, keys_at = rows["doc"].to_numpy(), rows["text_key"].to_numpy()
        again = (size[group] > 1) & ~known[piece]
        sort = np.lexsort((place[again], piece[again]))
        piece_again, place_again = piece[again][sort], place[again][sort]
        cuts = np.flatnonzero(np.diff(piece_again)) + 1
        for own, at in zip(np.split(piece_again, cuts), np.split(place_again, cuts)):
            for a, b in _ranges(at):
                p = own[0]
                out.append((docs_at[p], keys_at[p], low[p] + a, low[p] + b, None, None))
        # Of split anchors, one of each different window is told to the other shards.
        first = np.flatnonzero(~shared & split[piece])
        for at in first.tolist():
            p, a = piece[at], place[at]
            mark = xxhash.xxh3_128_digest(texts[p][a : a + length])
            sure = bool(size[group[at]] > 1 or known[p])
            out.append((docs_at[p], keys_at[p], low[p] + a, low[p] + a, mark, sure))
        return pd.DataFrame(out, columns=["doc", "text_key", "low", "high", "prints", "known"])

    solved = materialize(dealt.groupBy("shard").applyInPandas(solve, FOUND), "solved")
    marks = solved.where("prints IS NOT NULL")

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Of one range of fingerprints: those that more than one shard has."""
        prints = np.array([int.from_bytes(p[:8], "big") for p in rows["prints"]], np.uint64)
        rest = np.array([int.from_bytes(p[8:], "big") for p in rows["prints"]], np.uint64)
        order = np.lexsort((rest, prints))
        prints, rest = prints[order], rest[order]
        low, high = np.searchsorted(prints, prints, "left"), np.searchsorted(prints, prints, "right")
        twice = np.array([(rest[a:b] == r).sum() > 1 for a, b, r in zip(low, high, rest)], bool)
        hit = rows.iloc[order[twice]]
        return hit[~hit["known"].astype(bool)][["doc", "text_key", "low", "high"]]

    per_task = groups_of(marks.count(), 1 << 18)
    bucket = F.pmod(F.xxhash64("prints"), F.lit(per_task))
    merged = marks.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(
        merge, "doc long, text_key long, low int, high int"
    )
    return repeated.unionAll(solved.where("prints IS NULL").select(repeats.RANGE)).unionAll(merged)


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of each row of ``docs``.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the texts,
    the same text included. Strings never cross texts and are judged on what is given. A null text is
    empty; texts shorter than ``length`` stay as they are; repeated rows remove each other's bytes,
    the first as well as the others. A cut may fall inside a character, so ``kept`` is binary.
    """
    given = repeats.keyed(docs)
    ranges = repeated_ranges(given, length)
    found = repeats.by_document(given, ranges)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                raw, bounds = text_bytes(batch.column("text"))
                rows = []
                for i, (doc, own) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "found")))):
                    text = raw[bounds[i] : bounds[i + 1]]
                    gone = repeats.covered(own, length, len(text)) if own else np.zeros(len(text), bool)
                    kept = text[~gone].tobytes()
                    spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(text) else 0
                    rows.append(
                        (None if doc == repeats.NO_ID else doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
                    )
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return found.select("doc", "text", "found").mapInArrow(remove, schema)
