import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import sketches

SCHEMA = "doc_id long, text string, guest int"


def rows_of(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    return sketches.compare_with_edits(docs).collect()


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_edits_and_order(spark):
    rnd = random.Random(1)
    rows = [(i * 7919 % 100003 * (1 if i % 3 else 1000), words(rnd, rnd.randint(0, 60)) + "é漢") for i in range(120)]
    rows += [(500_000_000, None), (500_000_001, ""), (500_000_002, "x")]
    given = sorted(((i, t or "") for i, t in rows))
    got = {r.doc_id: r for r in rows_of(spark, rows)}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(given):
        following = given[(at + 1) % len(given)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1.0


def test_blocks_of_any_size_give_the_same(spark):
    docs = spark.createDataFrame(sorted({i * i % 1009: f"text {i}" for i in range(300)}.items()), "doc_id long, text string")
    found = []
    for rows_per_block, fan in ((4096, 4096), (7, 3), (1, 2)):
        rows, _ = sketches.with_next_text(docs, rows_per_block, fan)
        found.append(sorted(map(tuple, rows.where("NOT guest").select("doc_id", "text", "next_text").collect())))
    ids = [i for i, *_ in found[0]]
    texts = dict((i, t) for i, t, _ in found[0])
    assert found[0] == found[1] == found[2]
    assert [n for *_, n in found[0]] == [texts[i] for i in [*ids[1:], ids[0]]]


def test_likeness_is_near_the_truth(spark):
    rnd = random.Random(2)
    text = words(rnd, 2000)
    rows = [(0, text), (1, text), (2, words(rnd, 2000)), (3, "")]
    first, second, third, last = sorted(rows_of(spark, rows), key=lambda r: r.doc_id)
    assert first.near_next == 1.0 and first.fingerprint == second.fingerprint
    assert abs(first.near_edited - 0.5) < 0.06  # its first half twice
    assert second.near_next == 0.0 and abs(second.near_edited - 1 / 3) < 0.05 and abs(second.in_edited - 0.5) < 0.06
    assert third.near_next == 0.0 and last.fingerprint == "" and last.near_edited == 1.0


def test_containment_of_a_small_part(spark):
    rnd = random.Random(3)
    whole = words(rnd, 8000)
    part = " ".join(whole.split()[1000:1400])
    df = spark.createDataFrame([(part, whole)], "part string, whole string")
    df = sketches.add_fingerprint(sketches.add_fingerprint(df, "part", "a"), "whole", "b")
    (row,) = df.select(
        sketches.containment(F.col("a"), F.col("b")).alias("c"), sketches.likeness(F.col("a"), F.col("b")).alias("j")
    ).collect()
    assert row.c == 1.0 and abs(row.j - 0.05) < 0.02


def test_rows_without_ids_copies_and_single_rows(spark):
    got = rows_of(spark, [(None, "abcdef"), (5, "ghijkl"), (5, "ghijkl")])
    edited = {r.doc_id: r.edited_sha256 for r in got}
    assert len(got) == 3
    assert edited[None] == hashlib.sha256(b"abcghi").hexdigest()
    assert edited[5] == hashlib.sha256(b"ghighi").hexdigest()
    (alone,) = rows_of(spark, [(1, "abcd")])
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    (alone,) = rows_of(spark, [(None, "abcd")])
    assert alone.edited_sha256 == hashlib.sha256(b"ab").hexdigest()
    assert rows_of(spark, []) == []
