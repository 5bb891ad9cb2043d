"""The pipeline's stages against plain versions on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallybrook.llm import packing, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.materialize(stage(spark, docs[-1], DATA), "stage"))
    return docs


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_shrinking_ids(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns
        assert after.exceptAll(after.dropDuplicates()).count() == 0
        assert set(ids(after)) <= set(ids(before))
    assert ids(stages[1]) and set(ids(stages[-1])) == set(ids(stages[-2]))


def test_labels_are_heeded(spark, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = set(ids(stages[1]))
    clean = [i for i, label in labels.items() if label == (1, 0)]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)


def test_lines_go_once(stages):
    seen = set()
    for r in stages[2].orderBy("doc_id").collect():
        assert r.n_chars == len(r.text)
        for line in r.text.split("\n"):
            if len(line) >= 24:
                assert line not in seen
                seen.add(line)


def test_packing_is_whole(stages):
    rows = stages[5].toPandas().sort_values(["sequence_id", "offset"])
    own = rows.groupby("sequence_id")["length"]
    assert ((own.cumsum() - rows["length"]) == rows["offset"]).all() and own.sum().max() <= 1024
    assert rows["length"].sum() == packing.token_pieces(stages[4]).toPandas()["length"].sum()


def test_registered_queries(spark):
    names = set(queries.QUERIES)
    assert {f"op{n}_" for n in range(1, 14)} == {n[: n.index("_") + 1] for n in names - {"pipeline"}}
    assert names <= set(entry.queries())
    for name in ("op1_document_fingerprints", "op3_line_dedup", "op5_ordinal_quality", "op7_source_mixing", "op10_token_counts"):
        assert queries.QUERIES[name](spark, DATA).count() == 200


def test_nothing_else_imports_the_package():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    others = [p for p in (root / "tallybrook").rglob("*.py") if "llm" not in p.parts]
    assert others and not any("tallybrook.llm" in p.read_text() for p in others)


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert queries.QUERIES["op5_ordinal_quality"](spark, str(tmp_path)).count() == 0


def test_without_ratings_all_documents_stay(spark, tmp_path):
    spark.read.parquet(f"{DATA}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert ids(corpus_pipeline.rate_quality(spark, docs, str(tmp_path))) == ids(docs)


def test_own_columns_of_clashing_names_keep_their_values(spark):
    names = ["kept", "n_removed", "n_lines", "p_top", "expected_grade", "tokens", "topic", "factor", "probability", "selected"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    for stage in (corpus_pipeline.rate_quality, corpus_pipeline.remove_lines, corpus_pipeline.mix_sources):
        rows = stage(spark, docs, DATA).collect()
        assert rows and rows[0].__fields__ == docs.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
