"""Remove word strings that occur more than once in a corpus, by recompression.

Rounds name runs of one symbol and pairs of neighbours: a run becomes a symbol, then each symbol falls
to the left or the right class by a bit of its name, and a left one before a right one becomes a symbol.
A name is a hash of the parts' names, so it is the same wherever the parts are met and no table of names
has to be kept or shuffled. What a symbol became depends on a few words around it, and that context is
carried along: equal strings have equal symbols wherever the context lies inside them.

A window of 35 words is anchored at the least of its highest symbols whose context it holds. Anchors that
occur once settle most windows, and segments of equal symbols and words settle most others (see
:mod:`repeats`). Only where one anchor has several contents, windows are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm import repeats
from tallybrook.llm.common import chunks, materialize
from tallybrook.llm.words import mix, split_words, word_hashes

ROUNDS = ("runs", "pairs", "pairs", "pairs")
_BASE = 0x9E3779B97F4A7C15


class Level:
    """Symbols in order: name, text, and the words [low, high) that they depend on."""

    def __init__(self, name: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.name, self.text, self.low, self.high = name, text, low, high


def _neighbours(level: Level, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the symbol before is of the same text, and what of the words a look to each side takes in.

    A look past the end of a text takes in a word that no window holds.
    """
    joined = np.zeros(len(level.name), bool)
    joined[1:] = level.text[1:] == level.text[:-1]
    low = np.where(joined, np.append(0, level.low[:-1]), starts[level.text] - 1)
    high = np.where(np.append(joined[1:], False), np.append(level.high[1:], 0), starts[level.text + 1] + 1)
    return joined, low, high


def name_runs(level: Level, starts: np.ndarray) -> Level:
    """Each longest run of one symbol as a symbol. Where it ends depends on both neighbours."""
    joined, low, high = _neighbours(level, starts)
    first = np.flatnonzero(~(joined & np.append(False, level.name[1:] == level.name[:-1])))
    last = np.append(first[1:], len(level.name)) - 1
    times = last - first + 1
    name = level.name[first]
    name = np.where(times == 1, name, mix(name + mix(times.astype(np.uint64))))
    return Level(name, level.text[first], low[first], high[last])


def name_pairs(level: Level, starts: np.ndarray, turn: int) -> Level:
    """Each symbol of the left class with a right one after it as a symbol; the others stay."""
    joined, low, high = _neighbours(level, starts)
    left = mix(level.name + np.uint64(turn)) >> np.uint64(63) == 0
    second = joined & ~left & np.append(False, left[:-1])
    first = np.append(second[1:], False)
    # A left one alone has seen what follows, a right one alone what comes before.
    low = np.where(left | second, level.low, low)
    high = np.where(left & ~first, high, level.high)
    kept = np.flatnonzero(~second)
    pair = first[kept]
    other = np.minimum(kept + 1, len(level.name) - 1)
    name = np.where(pair, mix(mix(level.name[kept] + np.uint64(turn)) + level.name[other]), level.name[kept])
    return Level(name, level.text[kept], low[kept], np.where(pair, level.high[other], high[kept]))


def levels(names: np.ndarray, starts: np.ndarray) -> list[Level]:
    where = np.arange(len(names))
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    out = [Level(names, text, where, where + 1)]
    for turn, kind in enumerate(ROUNDS):
        out.append(name_runs(out[-1], starts) if kind == "runs" else name_pairs(out[-1], starts, turn))
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def string_hashes(names: np.ndarray):
    """``hash(low, high)`` of the names in [low, high), for arrays of bounds."""
    up, down = _powers(_BASE, len(names) + 1), _powers(pow(_BASE, -1, 1 << 64), len(names) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(names * up[:-1], dtype=np.uint64)))
    return lambda low, high: mix((total[high] - total[low]) * down[low] + (high - low).astype(np.uint64))


def anchored(names: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each window: its first word, text, level and number of the symbol, and the words that that depends on."""
    counts = np.diff(starts)
    at = np.flatnonzero(np.arange(len(names)) + length <= np.repeat(starts[1:], counts))
    text = np.repeat(np.arange(len(counts)), counts)[at]
    level_of, symbol = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    low, high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    for number, level in reversed(list(enumerate(levels(names, starts)))):
        if not len(todo):
            break
        a = np.searchsorted(level.low, at[todo], "left")
        b = np.searchsorted(level.high, at[todo] + length, "right")
        has = b > a
        own, a, b = todo[has], a[has], b[has]
        # The least hash of a range of symbols, the first of equals, from ranges of 1, 2, 4, ...
        index = np.arange(len(level.name), dtype=np.uint64)
        least = [(mix(level.name + np.uint64(7)) >> np.uint64(32) << np.uint64(32)) | index]
        while len(b) and 1 << len(least) <= int((b - a).max()):
            half = 1 << (len(least) - 1)
            least.append(np.minimum(least[-1], np.append(least[-1][half:], np.full(min(half, len(index)), ~np.uint64(0)))))
        size = np.frexp((b - a).astype(np.float64))[1] - 1
        best = np.zeros(len(own), np.uint64)
        for k, table in enumerate(least):
            of = size == k
            best[of] = np.minimum(table[a[of]], table[b[of] - (1 << k)])
        best = (best & np.uint64((1 << 32) - 1)).astype(np.int64)
        level_of[own], symbol[own], low[own], high[own] = number, best, level.low[best], level.high[best]
        todo = todo[~has]
    return at, text, level_of, symbol, low, high


def window_segments(length: int):
    """``find`` for :func:`repeats.segments` over windows of ``length`` words."""

    def find(texts: pa.Array):
        names, starts = word_hashes(texts)
        at, text, level, symbol, seen_from, seen_to = anchored(names, starts, length)
        first = repeats.first_per_window(at, symbol * 16 + level, text)
        last = np.append(first[1:], len(at)) - 1 if len(first) else first
        low, high = at[first], at[last]
        hashed = string_hashes(names)
        # All words of the context: a symbol of two common words alone would be met in many places.
        anchor = mix(hashed(seen_from[first], seen_to[first]) + level[first].astype(np.uint64))
        content = hashed(low, high + length) + mix((seen_from[first] - low).astype(np.uint64))
        begin = starts[text[first]]
        return text[first], anchor, content, low - begin, high - begin

    return find


def _open_windows(docs: DataFrame, open_segments: DataFrame, length: int) -> DataFrame:
    """Each window of the open segments by its hash: anchor, print, known, doc, text_key, low."""
    wanted = open_segments.groupBy("doc", "text_key").agg(
        F.collect_set(F.struct("anchor", (F.col("copies") > 1).alias("known"), "low", "high")).alias("cut")
    )
    here = docs.join(wanted, ["doc", "text_key"]).dropDuplicates(["doc", "text_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                names, starts = word_hashes(batch.column("text"))
                hashed = string_hashes(names)
                for i, cuts in enumerate(batch.column("cut").to_pylist()):
                    low = np.concatenate([np.arange(c["low"], c["high"] + 1) for c in cuts])
                    n = np.array([c["high"] + 1 - c["low"] for c in cuts])
                    at = low + starts[i]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array([c["anchor"] for c in cuts], np.int64), n)),
                            pa.array(hashed(at, at + length).view(np.int64)),
                            pa.array(np.repeat([c["known"] for c in cuts], n)),
                            pa.array(np.full(len(low), batch.column("doc")[i].as_py(), np.int64)),
                            pa.array(np.full(len(low), batch.column("text_key")[i].as_py(), np.int64)),
                            pa.array(low.astype(np.int32)),
                        ],
                        names=["anchor", "print", "known", "doc", "text_key", "low"],
                    )

    schema = "anchor long, print long, known boolean, doc long, text_key long, low int"
    return materialize(here.select("doc", "text_key", "text", "cut").mapInArrow(cut, schema), "windows")


def repeated_ranges(docs: DataFrame, length: int) -> DataFrame:
    """doc, text_key, low, high: the first words of windows that occur more than once in ``docs``."""
    repeated, open_segments = repeats.settle(repeats.segments(docs, window_segments(length)))
    windows = _open_windows(docs, open_segments, length)
    # Both hashes are of the same words: 128 bits that must agree.
    twice = windows.groupBy("anchor", "print").agg(F.count("*").alias("n"), F.max("known").alias("sure")).where("n > 1 OR sure")
    more = windows.where("NOT known").join(twice.select("anchor", "print"), ["anchor", "print"])
    return repeated.unionAll(more.select("doc", "text_key", "low", F.col("low").alias("high")))


def remove_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, a space between) of each row.

    Words are runs of anything but ASCII white space, unchanged. A word goes if a string of ``length``
    words that covers it also starts anywhere else, the same text included. Strings never cross texts
    and are judged on what is given. A null text has no words; texts of fewer words than ``length``
    keep them all; repeated rows remove each other's words, the first as well as the others.
    """
    given = repeats.keyed(docs)
    found = repeats.by_document(given, repeated_ranges(given, length))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                codes, starts, different = split_words(batch.column("text"))
                words = np.array(different.to_pylist(), object)
                rows = []
                for i, (doc, own) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "found")))):
                    text = codes[starts[i] : starts[i + 1]]
                    gone = repeats.covered(own, length, len(text)) if own else np.zeros(len(text), bool)
                    kept = b" ".join(words[text[~gone]].tolist()) if len(text) else b""
                    rows.append(
                        (None if doc == repeats.NO_ID else doc, len(text), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode())
                    )
                types = [pa.int64()] * 3 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return found.select("doc", "text", "found").mapInArrow(remove, schema)
