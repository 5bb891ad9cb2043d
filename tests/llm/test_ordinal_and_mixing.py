import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import mixing, ordinal

DATA = "/root/testdata/sf0.01"


def test_held_out_grades(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    rated = ordinal.graded(spark.read.parquet(f"{DATA}/labels.parquet"))
    train, held = rated.where("doc_id % 4 <> 0"), rated.where("doc_id % 4 = 0")
    model = ordinal.train(docs, train, ordinal.GRADES)
    assert (np.diff(model.thresholds) > 0).all()
    rows = ordinal.rate(docs, model).join(held, "doc_id").where("grade IS NOT NULL").toPandas()
    kept = rows["p_top"] >= 0.5
    assert kept[rows["grade"] == 2].mean() > 0.97
    assert kept[rows["grade"] == 1].mean() < 0.1  # poor ones
    means = rows.groupby("grade")["expected_grade"].mean()
    assert means[2] > 1.9 and means[2] > means[0] + 0.3 and means[1] < 1.2


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    texts = pa.array([" ".join(rng.choice(list("abcdefgh"), 6)) + (" good" * int(g)) for g in rng.integers(0, 3, 300)])
    grade = np.array([t.as_py().count("good") for t in texts])
    model = ordinal.fit(*ordinal.features(texts), grade, 3)
    score = ordinal.scores(model, texts)
    tails = model.tails(score)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == grade).mean() > 0.95


def test_odd_texts_and_rows(spark):
    rows = [(1, "fine words here", 2), (2, None, 0), (3, "", 0), (4, "!!! !!!", 0), (5, "word " * 30000, 2), (1, "fine words here", 2)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, p_top string")
    rated = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (9, 1), (1, None), (2, 7)], "doc_id long, grade long")
    model = ordinal.train(docs, rated, 3)
    got = ordinal.rate(docs, model)
    assert got.columns == ["doc_id", "text", "expected_grade", "p_top"]
    assert got.count() == 6 and got.where("p_top IS NULL OR isnan(p_top)").count() == 0
    assert ordinal.rate(docs.where("false"), model).count() == 0
    assert ordinal.train(docs, rated.where("false"), 3) is None
    unrated = ordinal.rate(docs, None)
    assert unrated.columns == got.columns and unrated.where("expected_grade IS NULL AND p_top IS NULL").count() == 6


def test_graded(spark):
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 1), (5, None, 0), (6, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.grade for r in ordinal.graded(labels).collect()}
    assert got == {1: 1, 2: 2, 3: 0, 4: 0, 5: None, 6: 2}


def test_raking_meets_all_margins():
    rng = np.random.default_rng(1)
    cells = rng.integers(1, 50, (3, 4, 2)).astype(float)
    cells[0, 1, 0] = 0
    targets = [np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.6, 0.4])]
    factors, error = mixing.rake(cells, targets)
    share = cells * factors / cells.sum()
    assert error < 1e-9
    for axis, target in enumerate(targets):
        assert np.allclose(share.sum(axis=tuple(a for a in range(3) if a != axis)), target)
    # Raking keeps the odds within the table: they are those of the cells.
    odds = factors[1:, 1:, 1] * factors[:-1, :-1, 1] / (factors[1:, :-1, 1] * factors[:-1, 1:, 1])
    assert np.allclose(odds, 1)
    factors, _ = mixing.rake(np.zeros((2, 2)), [np.array([0.5, 0.5])] * 2)
    assert (factors == 1).all()


def test_samples_have_the_wanted_shares(spark):
    rnd = random.Random(4)
    rows = [
        (i, " ".join("word" for _ in range(rnd.randint(1, 40))), "big" if rnd.random() < 0.7 else f"s{i % 9}", rnd.choice(["en", "en", "de", None]))
        for i in range(20000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("selected", F.lit("clash"))
    targets = {"source": {"big": 0.4}, "lang": {"en": 0.5, "de": 0.3}}
    got = mixing.with_probabilities(mixing.described(docs), targets)
    assert got.count() == 20000 and got.agg(F.max("probability")).first()[0] == 1.0
    kept = got.where("selected").toPandas()
    total = kept["tokens"].sum()
    assert abs(kept[kept.source == "big"]["tokens"].sum() / total - 0.4) < 0.03
    assert abs(kept[kept.lang == "en"]["tokens"].sum() / total - 0.5) < 0.03
    assert abs(kept[kept.lang.isna()]["tokens"].sum() / total - 0.2) < 0.03
    again = got.where("selected").select("doc_id")
    assert again.exceptAll(got.where("selected").select("doc_id")).count() == 0


def test_mix_of_odd_and_no_rows(spark):
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "src0", "xx", 0), (2, "eins zwei", "src0", "de", 9)], schema)
    got = mixing.mix(docs).collect()
    assert len(got) == 3 and all(r.probability is not None and r.selected is not None for r in got)
    assert mixing.mix(docs.where("false")).count() == 0


def test_tempered():
    assert mixing.tempered({"a": 9.0, "b": 1.0, "c": 0.0}, 0.5) == {"a": 0.75, "b": 0.25}


@pytest.mark.parametrize("local", [True, False])
def test_all_sources_are_raked(spark, monkeypatch, local):
    if not local:
        monkeypatch.setattr(mixing, "LOCAL_CELLS", 0)
    rnd = random.Random(6)
    rows = [(i, f"s{min(rnd.randrange(1, 7), rnd.randrange(1, 7))}" if i % 40 else None, rnd.choice(["en", "en", "it"]), rnd.randint(0, 30)) for i in range(1500)]
    docs = spark.createDataFrame([(i, "x", *r) for i, *r in rows], "doc_id long, text string, source string, lang string, tokens long")
    got = mixing.with_probabilities(docs, {"source": None, "lang": None}, 0.5).toPandas()
    assert len(got) == 1500
    for column in ("source", "lang"):
        own = got[column].fillna("none")
        share = (got["tokens"] * got["factor"]).groupby(own).sum() / got["tokens"].sum()
        wanted = mixing.tempered(got["tokens"].groupby(own).sum().astype(float).to_dict(), 0.5)
        assert len(wanted) == {"source": 7, "lang": 2}[column]
        assert all(abs(share[k] - v) < 1e-8 for k, v in wanted.items())


def test_topic_is_that_of_the_whole_text(spark):
    body = "mountains mountains glaciers mountains "
    openings = [f"{c * 9} " for c in "abcdefghijkl"]
    texts = [o + body * 3 for o in openings] + [body, "tiny words", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.topic for r in mixing.described(docs).orderBy("doc_id").collect()]
    assert set(got[:12]) == {got[12]} and got[13] != "none" and got[14:] == ["none", "none"]


def test_counts_of_the_sample_do_not_meet_in_the_driver(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(9000)]
    rows = [(i, " ".join(rng.sample(words, 3000)) + " good" * (i % 3), i % 3) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade long").repartition(4)
    tracemalloc.start()
    try:
        model = ordinal.train(docs.select("doc_id", "text"), docs.select("doc_id", "grade"), 3)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert (model.index >= 0).sum() > 1000 and len(model.weights) == (model.index >= 0).sum() + ordinal.STYLE
    assert peak < 40e6  # the 1.8 million counts take more
