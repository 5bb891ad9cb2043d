import random
import re

import numpy as np
import pandas as pd
import pytest

from tallybrook.llm import parity_join
from tallybrook.llm.components import components

SCHEMA = "doc_id long, text string, node int"


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdef") for _ in range(4)) for _ in range(400)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    rows, bases = [], [prose(rnd.choice([3, 8, 30, 120, 300])) for _ in range(12)]
    for i in range(150):
        text = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(text).replace("a", "A" if i % 4 == 0 else "a")))
    rows += [(150, None), (151, ""), (152, "one"), (153, "One"), (154, " \t\n"), (155, "two words"), (156, "two  words")]
    return rows + [(None, "no id at all"), (3, rows[3][1])]


def brute(rows, n, num, den):
    sets = []
    for _, text in rows:
        lowered = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80), (2, 60)])
def test_matches_brute_force(spark, n, num, monkeypatch):
    rows = corpus(n)
    monkeypatch.setattr(parity_join, "TILE", 8)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    got = parity_join.similar_documents(docs, n, num, 100)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, n, num, 100)


def test_block_keys_are_shuffled_once(spark, monkeypatch):
    plans, write = {}, parity_join.materialize

    def kept(df, purpose):
        plans.setdefault(purpose, df._jdf.queryExecution().executedPlan().toString())
        return write(df, purpose)

    monkeypatch.setattr(parity_join, "materialize", kept)
    parity_join.similar_documents(spark.createDataFrame(corpus(3), "doc_id long, text string"), 3, 90, 100)
    assert plans["groups"].count("Generate explode(keys#") == 1 and "Join" not in plans["groups"]


def test_sketches_rule_out_pairs_before_their_texts_are_compared(spark, monkeypatch):
    rnd, kept, write = random.Random(7), {}, parity_join.materialize
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    vary = lambda times: " ".join(f"x{rnd.randrange(10**6)}" if k in at else w for at in [set(rnd.sample(range(200), times))] for k, w in enumerate(base))
    rows = [(i, vary(15)) for i in range(60)] + [(60, " ".join(base)), (61, vary(1)), (62, vary(1))]

    def keep(df, purpose):
        out = write(df, purpose)
        kept.setdefault(purpose, (out, df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(parity_join, "materialize", keep)
    got = parity_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 5, 80, 100)
    met = kept["groups"][0].where("group <> node").count()
    assert met > 20 and kept["fits"][0].count() < met / 4
    assert "MapInArrow" not in kept["bits"][1]  # sketches are made once, with the block keys


def test_empty_table(spark):
    assert parity_join.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_similar_sets_share_a_block():
    rng = np.random.default_rng(0)
    for num in (60, 80, 90, 99):
        for size in (1, 2, 5, 11, 40, 333, 2000):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
                out = rng.integers(0, len(a) * (100 - num) // (100 + num) + 1)  # so many go and as many come
                new = rng.integers(0, 2**63, out).astype(np.uint64)
                b = np.unique(np.concatenate((rng.permutation(a)[out:], new)))
                both = len(np.intersect1d(a, b))
                if 100 * both >= num * len(np.union1d(a, b)):
                    assert set(parity_join.block_keys(a, num, 100)) & set(parity_join.block_keys(b, num, 100))


def test_proposals_are_a_forest():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.sort(np.delete(base, k)) for k in (0, 1, 2)] + [np.unique(rng.integers(0, 2**63, 199).astype(np.uint64))]
    for whole in (False, True):
        held = [s.tobytes() if whole else parity_join._parities(s) for s in sets]
        rows = pd.DataFrame({"node": [1, 2, 3, 4], "component": [1, 2, 3, 4], "size": 199, "held": held})
        assert parity_join.propose(rows, 90, 100, whole) == [(1, 2), (1, 3)]
        assert parity_join.propose(rows.assign(component=[1, 1, 3, 4]), 90, 100, whole) == [(1, 3)]
        assert parity_join.propose(rows, 100, 100, whole) == []


def test_components(spark):
    rnd = random.Random(9)
    pairs = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 160)]
    pairs += [(200, k) for k in range(201, 260)] + [(7, 7), (None, 3)]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_id_and_of_none(spark):
    words = [f"w{k}" for k in range(60)]
    changed = lambda *at: " ".join("new" if k in at else w for k, w in enumerate(words))
    other = lambda name: " ".join(f"{name}{k % 50}" for k in range(50))
    # 7 has three texts; one is near that of 2. Only the row without an id connects 10 and 11.
    rows = [(7, other("x")), (7, changed(0)), (7, other("y")), (2, changed()), (4, other("x") + " tail"), (5, other("y") + " tail")]
    bridge = [f"b{k}" for k in range(100)]
    rows += [(10, " ".join(bridge[8:])), (None, " ".join(bridge)), (11, " ".join(bridge[:-8])), (None, other("z"))]
    got = parity_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100)
    expected = brute(rows, 3, 90, 100)
    assert (11, 90, 10) in expected and (7, 58, 2) in expected
    assert sorted(map(tuple, got.collect()), key=repr) == expected
