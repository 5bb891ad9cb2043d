import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import phrases

DOCS = "doc_id long, text string, lang string, phrase string, n string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def counted(rows):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return n, f


def brute_force(rows, least=30, top=2000):
    n, f = counted(rows)
    chosen = {x for x, a in f.items() if len(x[1]) > 1 and a >= least}
    covered = set()
    for lang, words in chosen:
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, words[i : i + k])
                if 100 * f[lang, words] >= 80 * f[inner]:
                    covered.add(inner)
    out = []
    for lang in n:
        own = []
        for x in chosen - covered:
            if x[0] == lang:
                a, words = f[x], x[1]
                cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
                score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
                own.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def made(seed, n=160):
    """Texts of a skewed vocabulary with set phrases, other separators and two spellings of case."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "É", "don't", "\U0001f600", "\xa0x", "­", "a\x00b", "x\x1cy"]
    share = 1 / np.arange(1, len(words) + 1)
    fixed = ["New York City Hall", "new york", "in order to", "kick THE bucket", "as soon as possible", "ha ha ha ha ha"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", ";", ":", "! ", "?\n", "\n", "\r\n", "\x0b", "\x0c", " - "]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(int(rng.integers(0, 60))):
            parts.append(str(rng.choice(fixed)) if rng.random() < 0.15 else str(rng.choice(words, p=share / share.sum())))
            parts.append(str(rng.choice(ends)))
        rows.append((i, "".join(parts), [None, "und", "en", "en", "en", "de"][i % 6], "x", "y"))
    return rows + [(3, None, "en", None, None), (3, "", "fr", None, None), (None, "New York City Hall", "en", None, None), (4, rows[5][1] * 40, "de", "", "")]


@pytest.mark.parametrize("sample_bytes", [1 << 20, 6000, 60, 1])
def test_counts_are_exact_whatever_the_sample(spark, sample_bytes):
    rows = made(sample_bytes % 97)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    n, f = counted(rows)
    expected = {(lang, " ".join(words)): a for (lang, words), a in f.items() if a >= 30} | {(lang, ""): a for lang, a in n.items() if a}
    got = phrases.frequent_phrases(docs, 30, sample_bytes=sample_bytes).collect()
    assert len(got) == len({(r.lang, r.phrase) for r in got})
    assert {(r.lang, r.phrase): r.n for r in got} == expected


@pytest.mark.parametrize("options", [{}, {"sample_bytes": 3000, "field_bits": 12}])
def test_collocations_are_those_of_brute_force(spark, options):
    rows = made(5, 400)
    got = phrases.collocations(spark.createDataFrame(rows, DOCS), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_force(rows)
    assert len(expected) > 30
    assert sorted(map(tuple, got.collect())) == expected


def test_few_are_kept_with_ties(spark):
    rows = [(0, "b a. c d. " * 40, "en", "", ""), (1, "x y! x y! " * 20, "en", "", ""), (2, "e f\n" * 35, "de", "", "")]
    got = phrases.collocations(spark.createDataFrame(rows, DOCS), top=2)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, top=2)


def test_passes_go_on_until_closed(spark):
    """Nothing is proposed: each pass brings in phrases of one word more."""
    rows = [(i, "one two three four five", "en", "", "") for i in range(30)]
    got = phrases.frequent_phrases(spark.createDataFrame(rows, DOCS), 30, sample_bytes=1)
    assert {r.phrase: r.n for r in got.collect()}["two three four five"] == 30
    with pytest.raises(RuntimeError):
        phrases.frequent_phrases(spark.createDataFrame(rows, DOCS), 30, sample_bytes=1, most_passes=3)


def test_large_numbers_are_exact(spark):
    big = 6_000_000_000_000
    row = spark.range(1).selectExpr(f"cast({big} as decimal(20,0)) * cast(2000000 as decimal(18,0)) div cast({2 * big + 1} as decimal(20,0)) AS s")
    assert row.first().s == 2000000 * big // (2 * big + 1)


def test_hashes_agree():
    text = phrases.Text(pa.array(["New york  city", None, "new"]), pa.array(["en", "de", "de"]))
    own = phrases.phrase_hashes(["en", "en", "de"], ["new york", "new", "new"])
    assert len(set(own.tolist())) == 3
    field = np.zeros(1 << 20, np.int64)
    at = phrases.Field.place(own[1:2], 26)
    field[at >> 6] = np.left_shift(1, at & 63)
    assert phrases.Field(field.tobytes()).holds(own).tolist() == [False, True, False]
    assert text.words.to_pylist() == [b"new", b"york", b"city"] and text.piece.tolist() == [1, 1, 1, 3]


def test_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, "", ""), (2, " ,\n", "en", "", "")], DOCS)).count() == 0
