"""A corpus pipeline of five stages: rate, remove repeated lines, remove near copies, mix, pack.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written and read again as the next one's ``docs``. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import line_dedup, mixing, ordinal, packing, parity_join
from tallybrook.llm.common import materialize, table


#: Columns of documents that the stages read; all others are carried along under spare names.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def beside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage(docs)`` with the columns of ``docs``: those of a name that the stage gives to its own keep their values."""
    spare = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in READ}
    done = stage(docs.withColumnsRenamed(spare))
    return done.select(*(F.col(spare.get(c, c)).alias(c) for c in docs.columns))


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the highest grade is at least as likely as not; the labels are those of ``sf_dir``.

    Where no document is rated nothing is known against any, and all stay.
    """
    model = ordinal.train(docs, ordinal.graded(table(spark, sf_dir, "labels")), ordinal.GRADES)
    return beside(docs, lambda given: ordinal.rate(given, model).where("p_top IS NULL OR p_top >= 0.5"))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has, or nearly; those that had no others go."""
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    length = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))

    def remove(given: DataFrame) -> DataFrame:
        found = line_dedup.remove_near_lines(given).where("n_removed = 0 OR kept <> ''")
        return found.withColumns({"text": text, "n_chars": length})

    return beside(docs, remove)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies; rows that repeat it go."""
    found = parity_join.similar_documents(docs)
    first = found.where("component_id = doc_id OR doc_id IS NULL").select("doc_id").distinct()
    # A document without an id is no other's copy by number, so all of them stay.
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["doc_id"]), "left_semi")
    return kept.where("doc_id IS NULL").unionAll(kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by probabilities that give sources, languages and topics their shares of tokens."""
    return beside(docs, lambda given: mixing.mix(given).where("selected"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality classifier", rate_quality),
    ("line dedup", remove_lines),
    ("n-gram Jaccard join", remove_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: A fitted model decides the first stage, which SQL cannot express; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
