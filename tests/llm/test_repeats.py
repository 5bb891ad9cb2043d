"""Byte and word repeats against brute force, on texts that are made to overlap."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallybrook.llm import recompression, suffix_dedup

SCHEMA = "doc_id long, text string, low int"


def corpus(seed, passage):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(passage) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared), prose(rnd.randint(0, 15))]
        rows.append((i, " ".join(parts)))
    rows += [(60, rows[5][1]), (61, rows[5][1] + " end"), (61, "another " + rows[6][1]), (62, None), (63, ""), (64, "ab " * 300)]
    rows += [(65, "x" * 900), (66, "x" * 500), (None, rows[7][1]), (5, rows[5][1])]
    return rows


def gone(texts, length):
    counts = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            w = tuple(t[k : k + length])
            counts[w] = counts.get(w, 0) + 1
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if counts[tuple(t[k : k + length])] > 1:
                mask[k : k + length] = True
        out.append(mask)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed, monkeypatch):
    rows = corpus(seed, 30)
    length = 40
    texts = [(t or "").encode() for _, t in rows]
    expected = []
    for (doc_id, _), text, mask in zip(rows, texts, gone(texts, length)):
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        spans = int((mask & ~np.append(False, mask[:-1])).sum()) if len(mask) else 0
        expected.append((doc_id, len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    got = suffix_dedup.remove_repeats(docs, length).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_hot_anchors_are_split_and_merged(spark):
    rows = corpus(3, 30)
    length = 40
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    given = suffix_dedup.repeats.keyed(docs)

    def covered(**options):
        marks = set()
        for r in suffix_dedup.repeated_ranges(given, length, **options).distinct().collect():
            marks |= {(r.doc, r.text_key, k) for k in range(r.low, r.high + 1)}
        return marks

    assert covered(shard_bytes=60) == covered()


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = corpus(seed, 12)
    length = 7
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    expected = []
    for (doc_id, _), text, mask in zip(rows, texts, gone(texts, length)):
        kept = " ".join(w for w, m in zip(text, mask) if not m)
        expected.append((doc_id, len(text), int(mask.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    got = recompression.remove_repeats(docs, length).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert recompression.remove_repeats(docs).count() == 0


def test_suffix_windows_by_brute_force():
    rnd = random.Random(4)
    for _ in range(60):
        length = rnd.choice([9, 12, 33])
        base = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 120))) for _ in range(3)]
        pieces = [rnd.choice(base)[rnd.randint(0, 5) :] + rnd.choice(base)[: rnd.randint(1, 60)] for _ in range(6)]
        piece, place, shared = suffix_dedup.repeated_windows(pieces, length)
        counts = {}
        for p in pieces:
            for k in range(len(p) - length + 1):
                counts[p[k : k + length]] = counts.get(p[k : k + length], 0) + 1
        assert len(piece) == sum(counts.values())
        if len(piece):
            group = np.cumsum(~shared) - 1
            size = np.bincount(group)
            for g, p, k in zip(group, piece, place):
                assert counts[pieces[p][k : k + length]] == size[g]


def test_equal_strings_have_equal_symbols_inside():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 4, 60).astype(np.uint64)
    for _ in range(20):
        a = np.concatenate((rng.integers(0, 4, 9).astype(np.uint64), shared, rng.integers(0, 4, 5).astype(np.uint64)))
        b = np.concatenate((rng.integers(0, 4, 3).astype(np.uint64), shared))
        one = recompression.levels(a, np.array([0, len(a)]))[-1]
        two = recompression.levels(b, np.array([0, len(b)]))[-1]
        inside = lambda level, start: {
            (n, lo - start, hi - start)
            for n, lo, hi in zip(level.name.tolist(), level.low.tolist(), level.high.tolist())
            if lo >= start and hi <= start + 60
        }
        assert inside(one, 9) == inside(two, 3) != set()
