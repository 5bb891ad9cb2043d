"""Registered queries: name -> (session, folder) -> DataFrame, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import bit_packing, line_dedup, metric_tree, mixing, ordinal, packing, parity_join, phrases, recompression, sketches, suffix_dedup, token_alignment, token_files
from tallybrook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, folder, "documents")))


@query
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("long"), metric_tree.scaled(F.col("embedding")).alias("x")
    )
    return metric_tree.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.document_token_counts(table(spark, folder, "documents"))


@query
def op11_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bit_packing.document_ids(table(spark, folder, "documents"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignments(table(spark, folder, "documents"))


@query
def op13_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query
def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.similar_documents(table(spark, folder, "documents"), n=3, num=90, den=100)


@query
def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op4_recompression_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op1_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.compare_with_edits(table(spark, folder, "documents"))


@query
def op5_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = ordinal.train(docs, ordinal.graded(table(spark, folder, "labels")), ordinal.GRADES)
    return ordinal.rate(docs, model).drop("text").withColumn("keep", F.col("p_top") >= 0.5)


@query
def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("text", "n_chars")


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.remove_near_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
