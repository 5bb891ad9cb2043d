import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import metric_tree

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    vectors = df.select("vec_id", metric_tree.scaled(F.col("embedding")).alias("x"))
    got = metric_tree.top_k(vectors, vectors.where("vec_id % 50 = 0"), **options)
    return sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("options", [{}, {"rows_per_shard": 100, "queries_per_block": 3}])
def test_matches_brute_force(spark, options):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]  # ties
    rows += [(2000, None), (2050, [float("nan")] * 8), (2100, [1.0, None] * 4), (None, [9.0] * 8), (2150, [float("inf")] * 8)]
    assert found(spark, rows, **options) == brute(rows)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (3, [1.0])]
    assert found(spark, rows) == [(0, 1, 3, 256 * 256)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_pages_cover_their_vectors():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (3000, 6))
    most = float((x.astype(float) ** 2).sum(axis=1).max())
    pages = {p[0]: p[1:] for p in metric_tree.build_pages(np.arange(3000), x, most)}
    assert sorted(i for leaf, ids, *_ in pages.values() if leaf for i in ids) == list(range(3000))
    assert all(len(ids) <= metric_tree.PAGE for _, ids, *_ in pages.values())
