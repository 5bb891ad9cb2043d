"""Words of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from tallybrook.llm.common import text_bytes

#: What separates words: the space and the five controls from tab to carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers in a row, where each text's words begin (and the end), and the different words.

    Words are runs of bytes that are no white space of ASCII. ``lower`` turns A-Z into a-z. A null
    text has no words.
    """
    raw, bounds = text_bytes(texts)
    if lower:
        raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    begins[heads] = inside[heads]  # a word ends where its text ends
    at = np.flatnonzero(begins)
    del begins
    letters = np.cumsum(inside, dtype=np.int32)  # up to each byte, itself included
    offsets = np.append(letters[at] - np.int32(1), letters[-1:] if len(letters) else np.int32(0)).astype(np.int32)
    del letters
    data = pa.py_buffer(raw[inside])
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), data])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(at, bounds), coded.dictionary


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in a row, and where each text's words begin (and the end)."""
    codes, starts, different = split_words(texts, lower)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different.to_pylist()), np.uint64, len(different))
    return hashes[codes] if len(codes) else np.empty(0, np.uint64), starts


def shingle_sets(texts: pa.Array, n: int, lower: bool = True) -> list[np.ndarray]:
    """For each text the sorted hashes of its different runs of ``n`` words.

    A text of fewer words has its whole sequence as the only one, a text without words has none.
    """
    hashes, starts = word_hashes(texts, lower)
    rolled = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for k in range(n):
        rolled = mix(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= n:
            sets.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            sets.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
