"""Mix sources to target weights: rake token counts to marginals, then sample by calibrated probabilities.

Tokens are counted for each cell of source, language and topic. Iterative proportional fitting scales the cells
in turn until the shares of each source, language and topic are those wanted. A document is kept with a
probability in proportion to its cell's factor, so the kept tokens have these shares in expectation.

A cell's factor is a product of one for each axis. Up to LOCAL_CELLS cells the fitting is done with arrays in the
driver, above that by grouped sums and joins of the tables of cells and factors; both do the same steps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import materialize

LOCAL_CELLS = 1 << 17
OTHER = "other"
WORD = r"[^\x20\x09-\x0D]+"


def tempered(counts: dict[str, float], power: float) -> dict[str, float]:
    """Shares in proportion to a power of the counts: 1 keeps them, 0 makes them equal."""
    raised = {k: v**power for k, v in counts.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()}


def long_words_topic(text: Column, topics: int = 8) -> Column:
    """A stand-in for a topic model: the bucket that most words of eight letters or more of the whole text hash to.

    Where there are none all words count. Of buckets with equally many words it is the lowest.
    """
    lowered = F.lower(text)
    words = F.regexp_extract_all(lowered, F.lit(r"\p{L}{8,}"), F.lit(0))
    words = F.when(F.size(words) > 0, words).otherwise(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)))
    buckets = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(topics)).cast("int"))
    numbers = F.sequence(F.lit(0), F.lit(topics - 1))

    def most(found: Column) -> Column:
        counts = F.transform(numbers, lambda k: F.size(F.filter(found, lambda b: b == k)))
        best = F.get(F.transform(F.array(counts), lambda c: F.array_position(c, F.array_max(c)) - 1), F.lit(0))
        return F.when(F.size(found) == 0, "none").otherwise(F.concat(F.lit("t"), best.cast("string")))

    return F.get(F.transform(F.array(buckets), most), F.lit(0))


def rake_axes(
    tokens: np.ndarray, codes: list[np.ndarray], wanted: list[np.ndarray], tolerance: float = 1e-10, rounds: int = 1000
) -> tuple[list[np.ndarray], float]:
    """Factors of each axis for cells given by their codes, and the largest error that is left, as a share of all tokens."""
    factors = [np.ones(len(w)) for w in wanted]
    total = tokens.sum()
    error = 0.0
    for _ in range(rounds if total else 0):
        error = 0.0
        for axis, target in enumerate(wanted):
            weight = np.prod([factors[a][codes[a]] for a in range(len(codes)) if a != axis], axis=0) * tokens
            now = np.bincount(codes[axis], weight, len(target))
            error = max(error, float(np.abs(now * factors[axis] - target).max() / total))
            factors[axis] = np.where(now > 0, target / np.where(now > 0, now, 1.0), factors[axis])
        if error < tolerance:
            break
    return factors, error


def rake(cells: np.ndarray, targets: list[np.ndarray], tolerance: float = 1e-10, rounds: int = 1000) -> tuple[np.ndarray, float]:
    """Factors for ``cells`` that give each axis its target shares, and the largest error that is left.

    A category without tokens cannot get any; the targets of the others are scaled up for it.
    """
    total = cells.sum()
    if not total:
        return np.ones_like(cells, dtype=np.float64), 0.0
    wanted = []
    for axis, target in enumerate(targets):
        held = cells.sum(axis=tuple(a for a in range(cells.ndim) if a != axis))
        wanted.append(_scaled(held, target))
    codes = [c.ravel() for c in np.indices(cells.shape)]
    factors, error = rake_axes(cells.ravel().astype(np.float64), codes, wanted, tolerance, rounds)
    return np.prod([f[c] for f, c in zip(factors, codes)], axis=0).reshape(cells.shape), error


def _scaled(held: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Wanted tokens of each category: its share of all, where it holds any."""
    target = np.where(held > 0, target, 0.0)
    if not target.sum():
        target = (held > 0).astype(np.float64)
    return target / max(target.sum(), 1e-300) * held.sum()


def _margin(cells: DataFrame, column: str, shares: dict[str, float] | None, power: float) -> DataFrame:
    """category, held and wanted tokens of one axis of ``cells``."""
    held = cells.groupBy(F.col(column).alias("category")).agg(F.sum("tokens").alias("held"))
    if shares is None:
        raised = held.withColumn("raised", F.when(F.col("held") > 0, F.pow("held", F.lit(power))).otherwise(0.0))
        sums = raised.agg(F.sum("raised"), F.sum("held")).first()
        scale = (sums[1] or 0.0) / max(sums[0] or 0.0, 1e-300)
        return raised.select("category", "held", (F.col("raised") * F.lit(scale)).alias("wanted"))
    rows = held.collect()  # the categories that have a share, and one for all others
    own = {r["category"]: r["held"] for r in rows}
    left = 1.0 - sum(shares.values())
    rest = left if left > 1e-12 else own.get(OTHER, 0.0) / max(sum(own.values()), 1.0)
    target = {**{f"={k}": v for k, v in shares.items()}, OTHER: rest}
    wanted = _scaled(np.array(list(own.values())), np.array([target[k] for k in own]))
    table = [(k, float(own[k]), float(w)) for k, w in zip(own, wanted)]
    return cells.sparkSession.createDataFrame(table, "category string, held double, wanted double")


def _factors(cells: DataFrame, margins: list[DataFrame], tolerance: float = 1e-10, rounds: int = 1000) -> list[DataFrame]:
    """category and f of each axis: the steps of :func:`rake_axes` as grouped sums and joins."""
    names = cells.columns[:-1]
    total = cells.agg(F.sum("tokens")).first()[0]
    factors = [m.select("category", F.lit(1.0).alias("f")) for m in margins]
    for _ in range(rounds if total else 0):
        error = 0.0
        for axis, margin in enumerate(margins):
            weighted = cells
            for other, factor in enumerate(factors):
                if other != axis:
                    weighted = weighted.join(factor.toDF(names[other], f"f_{other}"), names[other]).withColumn("tokens", F.col("tokens") * F.col(f"f_{other}"))
            now = weighted.groupBy(F.col(names[axis]).alias("category")).agg(F.sum("tokens").alias("now"))
            both = margin.join(now, "category").join(factors[axis].withColumnRenamed("f", "before"), "category")
            fitted = F.when(F.col("now") > 0, F.col("wanted") / F.col("now")).otherwise(F.col("before"))
            gap = F.abs(F.col("now") * F.col("before") - F.col("wanted"))
            fit = materialize(both.select("category", fitted.alias("f"), gap.alias("gap")), "factors")
            error = max(error, fit.agg(F.max("gap")).first()[0] / total)
            factors[axis] = fit.drop("gap")
        if error < tolerance:
            break
    return factors


def with_probabilities(
    docs: DataFrame, targets: dict[str, dict[str, float] | None], power: float | None = None, tokens: str = "tokens"
) -> DataFrame:
    """``docs`` with ``factor``, ``probability`` and ``selected``; all rows stay.

    ``targets`` has for each column the wanted share of some categories. Others of the column, and nulls,
    are pooled as "other", which gets what the shares leave up to one, or its own share if they leave
    nothing. A column with None for its shares has all categories that the data have, null among them, and
    the wanted shares are the data's own, tempered by ``power`` (None: as they are). No category is pooled
    then, however small. The highest factor has probability 1. The draw hashes the document's id and text: it is
    the same in every run and on every retry, and repeated rows share it. Rows without tokens have the factor of
    their cell.
    """
    columns = list(targets)
    cell = {c: f"_cell_{i}" for i, c in enumerate(columns)}

    def category(column: str) -> Column:
        value = F.col(column).cast("string")
        name, shares = F.concat(F.lit("="), value), targets[column]  # never OTHER
        return F.coalesce(name if shares is None else F.when(value.isin(*shares), name), F.lit(OTHER))

    named = docs.withColumns({cell[c]: category(c) for c in columns})
    weight = F.coalesce(F.col(tokens), F.lit(0)).cast("double")
    cells = materialize(named.groupBy(*cell.values()).agg(F.sum(weight).alias("tokens")), "cells")
    margins = [_margin(cells, cell[c], targets[c], 1.0 if power is None else power) for c in columns]
    few = cells.count() <= LOCAL_CELLS
    if few:
        rows = cells.toPandas()
        held = [m.toPandas() for m in margins]
        codes = [h.reset_index().set_index("category")["index"].loc[rows[cell[c]]].to_numpy(np.int64) for c, h in zip(columns, held)]
        found, _ = rake_axes(rows["tokens"].to_numpy(np.float64), codes, [h["wanted"].to_numpy(np.float64) for h in held])
        rows["factor"] = np.prod([f[c] for f, c in zip(found, codes)], axis=0) if len(rows) else 1.0
        table = [(*r[:-2], float(r[-2]), float(r[-1])) for r in rows.itertuples(index=False, name=None)]
        schema = ", ".join(f"{c} string" for c in cell.values()) + ", tokens double, factor double"
        factored = docs.sparkSession.createDataFrame(table, schema)
    else:
        factored = cells.withColumn("factor", F.lit(1.0))
        for c, found in zip(columns, _factors(cells, [materialize(m, "margins") for m in margins])):
            factored = factored.join(found.toDF(cell[c], "f"), cell[c]).withColumn("factor", F.col("factor") * F.col("f")).drop("f")
        factored = materialize(factored, "factors")
    high = factored.where("tokens > 0").agg(F.max("factor")).first()[0] or 1.0
    table = factored.select(*cell.values(), "factor", F.least(F.lit(1.0), F.col("factor") / F.lit(high)).alias("probability"))
    drop = [c for c in ("factor", "probability", "selected") if c in docs.columns]
    joined = named.drop(*drop).join(F.broadcast(table) if few else table, list(cell.values())).drop(*cell.values())
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("draw")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return joined.withColumn("selected", draw < F.col("probability"))


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with ``tokens`` (words) and ``topic``; a null text has no tokens and the topic "none"."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"tokens": F.regexp_count(text, F.lit(WORD)).cast("long"), "topic": long_words_topic(text)})


#: The production mix: all sources, languages and topics that the data have, each tempered.
TARGETS = {"source": None, "lang": None, "topic": None}
POWER = 0.9


def mix(docs: DataFrame, targets: dict[str, dict[str, float] | None] = TARGETS, power: float | None = POWER) -> DataFrame:
    """``docs`` (doc_id, text, source, lang) with tokens, topic, factor, probability and selected."""
    return with_probabilities(described(docs), targets, power)
