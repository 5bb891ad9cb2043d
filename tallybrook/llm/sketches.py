"""Threshold-scaled document fingerprints, in DataFrame functions only.

A document is the set of hashes of its runs of five words. Its fingerprint keeps every hash in the lowest
``1 / scale`` of the hash range. The share is fixed, so fingerprints of all documents are comparable however
unequal they are: that of a union is the union of the fingerprints, and the part of one fingerprint
that another one holds estimates how much of the document the other contains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallybrook.llm.common import groups_of

SPACE = r"[\x20\x09-\x0D]+"
SHINGLE = 5
SCALE = 4


def add_fingerprint(df: DataFrame, text: str, name: str, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``df`` with array ``name``: the sorted kept hashes of the column ``text`` (lower-cased).

    A text of fewer words is one run, a text without words has an empty fingerprint. If no hash is in
    the kept share the lowest one is kept, so that texts with words never have an empty one.
    """
    below = -(1 << 63) + (1 << 64) // scale
    words, hashes, kept = f"{name}_words", f"{name}_hashes", f"{name}_kept"
    df = df.withColumn(words, F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""))
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0)))
    run = F.transform(places, lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(shingle))))
    df = df.withColumn(hashes, F.when(F.size(words) > 0, run).otherwise(F.array().cast("array<bigint>"))).drop(words)
    df = df.withColumn(kept, F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < below))))
    lowest = F.array_compact(F.array(F.array_min(hashes)))
    return df.withColumn(name, F.when(F.size(kept) > 0, F.col(kept)).otherwise(lowest)).drop(hashes, kept)


def as_text(fingerprint: Column) -> Column:
    """The hashes in order, as signed numbers with commas between."""
    return F.array_join(fingerprint.cast("array<string>"), ",")


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two empty fingerprints."""
    both = F.size(F.array_intersect(one, two))
    either = F.size(one) + F.size(two) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(one: Column, two: Column) -> Column:
    """Estimated part of the first document that is in the second; 1 for an empty first."""
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) / F.size(one))


def with_next_text(docs: DataFrame, rows_per_block: int = 4096, fan: int = 4096) -> tuple[DataFrame, WindowSpec]:
    """``docs`` (doc_id not null, text) with next_text, and the window that orders the rows.

    Ids are cut into blocks of equal width, about ``rows_per_block`` rows where ids are even. A block's
    last row needs the first row of the next block that has any, which joins the block as a guest. So
    each text is shuffled once. Guests are marked in the column ``guest`` and are to be dropped.
    """
    figures = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high, n = figures["low"] or 0, figures["high"] or 0, figures["n"]
    width = groups_of(high - low + 1, groups_of(n, rows_per_block))
    block = F.expr(f"doc_id div {width}L")
    placed = docs.withColumn("block", block)
    heads = placed.groupBy("block").agg(F.min("doc_id").alias("head"))
    # The head of the next block: within a group of ``fan`` blocks, or else that of the next group.
    group = F.expr(f"block div {fan}L")
    groups = heads.groupBy(group.alias("group")).agg(F.min("head").alias("group_head"))
    # One row for each ``fan * rows_per_block`` documents: few thousands for a hundred billion.
    following = F.lead("group_head").over(Window.partitionBy(F.lit(0)).orderBy("group"))
    groups = groups.select("group", F.coalesce(following, F.lit(low)).alias("after"))
    within = F.lead("head").over(Window.partitionBy("group").orderBy("block"))
    guests = heads.withColumn("group", group).withColumn("next_head", within).join(groups, "group")
    guests = guests.select(F.coalesce("next_head", "after").alias("doc_id"), F.col("block").alias("host"))
    invited = docs.join(guests, "doc_id").select("doc_id", "text", F.col("host").alias("block"), F.lit(True).alias("guest"))
    order = Window.partitionBy("block").orderBy("guest", "doc_id", "text")
    rows = placed.select("doc_id", "text", "block", F.lit(False).alias("guest")).unionByName(invited)
    return rows.withColumn("next_text", F.lead("text").over(order)), order


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text), of an edited text, and how alike they are.

    The edited text has the last half of the characters (rounded down) replaced by as many of the next
    document's first ones, or all if it has fewer. The next document follows in the order of doc_id (rows of one
    id by their text), the first one follows the last, a single one itself. A null text is empty.
    Rows without an id come before all: the first document with an id is next to each of them (or
    an empty text if there is none).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows, order = with_next_text(given.where("doc_id IS NOT NULL"))
    columns = ["doc_id", "text", "next_text"]

    def compared(df: DataFrame) -> DataFrame:
        length = F.length("text")
        half = F.floor(length / 2).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring(F.col("next_text"), F.lit(1), half))
        df = df.withColumn("n_chars", length.cast("long")).withColumn("edited", edited)
        df = df.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
        return add_fingerprint(add_fingerprint(df, "text", "own"), "edited", "changed").drop("edited")

    result = _likenesses(compared(rows).withColumn("following", F.lead("own").over(order)).where("NOT guest"))
    if given.where("doc_id IS NULL").isEmpty():
        return result
    first = given.where("doc_id IS NOT NULL").orderBy("doc_id", "text").limit(1).collect()
    alone = given.where("doc_id IS NULL").withColumn("next_text", F.lit(first[0]["text"] if first else ""))
    alone = compared(alone.select(columns))
    return result.unionByName(_likenesses(add_fingerprint(alone, "next_text", "following")))


def _likenesses(df: DataFrame) -> DataFrame:
    own, changed, following = F.col("own"), F.col("changed"), F.col("following")
    return df.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, following).alias("near_next"),
        containment(own, changed).alias("in_edited"),
        containment(own, following).alias("in_next"),
    )
