"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import materialize


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that links reach.

    Each round groups by node with a minimum that tasks combine first, so a node with very many links
    is no burden; no component is gathered in one place. Links from a node to itself, repeated links
    and nulls are harmless: a null links nothing.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        edges = materialize(
            small.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .unionAll(low.select("a", F.col("low").alias("b")))
            .distinct(),
            "links",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links not settled after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
