"""Ordinal regression on graded ratings of texts: shared hashed weights, ordered thresholds.

The cumulative-link model gives a text one score from all weights, and the chance of at least grade ``k``
is the logistic function of the score less the ``k``-th threshold. Expected grade and tail
probability follow from these chances. Texts are counted words and word beginnings, hashed to a fixed number of weights,
and a few shares that describe the style.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.llm.common import chunks, materialize, text_bytes
from tallybrook.llm.words import split_words

WIDTH = 1 << 20
LEAST = 0.002  # a place counts if this share of the sample's texts has it, and at least five do
BEGINNING = 4  # bytes of a word that are counted besides the whole word
STYLE = 8


@dataclass
class Model:
    index: np.ndarray  # number of a hashed place among those that count, or -1
    rarity: np.ndarray  # of the places that count
    weights: np.ndarray  # of the places that count, then of the style
    thresholds: np.ndarray  # ascending, one less than there are grades
    centre: np.ndarray
    spread: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """Chance of at least grade 1, 2, ... by column."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, value) of the hashed counts, damped, and the style shares by text.

    Whole texts count. A null text and one without words have no counts and a style of zeros.
    """
    n = len(texts)
    codes, starts, words = split_words(texts, lower=True)
    names = words.to_pylist()
    digest = xxhash.xxh3_64_intdigest
    whole = np.fromiter((digest(w) % WIDTH for w in names), np.int64, len(names))
    begin = np.fromiter((digest(w[:BEGINNING], 1) % WIDTH for w in names), np.int64, len(names))
    text = np.repeat(np.arange(n), np.diff(starts))
    pair, times = np.unique(text * max(len(names), 1) + codes, return_counts=True)
    of, code = pair // max(len(names), 1), pair % max(len(names), 1)
    value = np.log1p(times)
    of, place, value = np.tile(of, 2), np.concatenate((whole[code], begin[code])), np.tile(value, 2)

    raw, bounds = text_bytes(texts)
    size = np.maximum(np.diff(bounds), 1)
    share = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds]) / size
    count = np.diff(starts)
    many = np.maximum(count, 1)
    different = np.bincount(pair // max(len(names), 1), minlength=n)
    again = np.append(False, (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])) if len(codes) else np.zeros(0, bool)
    style = np.column_stack(
        [
            np.log1p(count), different / many, np.bincount(text, again, n) / many,
            share((raw >= 65) & (raw <= 90)), share((raw >= 48) & (raw <= 57)),
            share(((raw >= 33) & (raw <= 47)) | ((raw >= 58) & (raw <= 64)) | (raw == 124)),
            share(raw == 33), share(raw == 10),
        ]
    )
    return of, place, value, np.where(count[:, None] > 0, style, 0.0)


def _scaled(of, place, value, index, rarity, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number, value) of the places that count: times rarity, of length one for each text."""
    number = index[place]
    counts = number >= 0
    of, value, number = of[counts], value[counts].astype(np.float64), number[counts]
    value *= rarity[number]
    length = np.sqrt(np.bincount(of, value**2, n))
    return of, number, value / np.where(length > 0, length, 1.0)[of]


def fit(of, place, value, style, grade, grades: int, rounds: int = 100, rate: float = 0.2, ridge: float = 1e-5) -> Model:
    """Adam on the likelihood of the grades. Thresholds are a first one and positive steps, so they stay in order."""
    n = len(grade)
    centre, spread = style.mean(axis=0), style.std(axis=0) + 1e-6
    dense = (style - centre) / spread
    held = np.bincount(place, minlength=WIDTH)
    counts = np.flatnonzero(held >= max(5, LEAST * n))
    index = np.full(WIDTH, -1, np.int32)
    index[counts] = np.arange(len(counts))
    rarity = np.log(n / np.minimum(held[counts], n)) + 0.1
    of, number, value = _scaled(of, place, value, index, rarity, n)
    del place
    width = len(counts)
    cuts = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n, 1e-3, 1 - 1e-3)
    first = np.log(cuts / (1 - cuts))
    theta = np.concatenate((np.zeros(width + STYLE), first[:1], np.log(np.maximum(np.diff(first), 1e-2))))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for turn in range(1, rounds + 1):
        weights, cut = theta[: width + STYLE], theta[width + STYLE :]
        thresholds = cut[0] + np.append(0.0, np.cumsum(np.exp(cut[1:])))
        score = np.bincount(of, value * weights[number], n) + dense @ weights[width:]
        tails = np.column_stack([np.ones(n), _logistic(score[:, None] - thresholds), np.zeros(n)])
        upper, lower = tails[rows, grade], tails[rows, grade + 1]
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = (low - up) / n  # of the negative log-likelihood
        by_cut = np.bincount(grade, up, grades)[1:] / n - np.bincount(grade, low, grades)[:-1] / n
        gradient = np.concatenate(
            [
                np.bincount(number, value * by_score[of], width) + ridge * weights[:width],
                dense.T @ by_score + ridge * weights[width:],
                [by_cut.sum()],
                np.exp(cut[1:]) * np.cumsum(by_cut[::-1])[::-1][1:],
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta - rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    cut = theta[width + STYLE :]
    return Model(index, rarity, theta[: width + STYLE], cut[0] + np.append(0.0, np.cumsum(np.exp(cut[1:]))), centre, spread)


#: A model as a row: the places that count, and the rest of :class:`Model` for them.
FITTED = "places array<int>, rarity array<double>, weights array<double>, thresholds array<double>, centre array<double>, spread array<double>"


def model_of(row: dict[str, list]) -> Model:
    index = np.full(WIDTH, -1, np.int32)
    index[row["places"]] = np.arange(len(row["places"]))
    return Model(index, *(np.array(row[name]) for name in ("rarity", "weights", "thresholds", "centre", "spread")))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    of, place, value, style = features(texts)
    of, number, value = _scaled(of, place, value, model.index, model.rarity, len(texts))
    hashed, dense = model.weights[:-STYLE], model.weights[-STYLE:]
    return np.bincount(of, value * hashed[number], len(texts)) + (style - model.centre) / model.spread @ dense


def train(docs: DataFrame, rated: DataFrame, grades: int, max_rows: int = 8000) -> Model | None:
    """Fit on a sample of at most ``max_rows`` rated texts, those of the least hash of their id.

    ``rated`` has doc_id and grade (0 to ``grades - 1``); rows with a null or another grade are left out,
    and a document rated twice counts twice. The sample is the only bounded part: its counts are
    made in the tasks, and at most ``max_rows`` texts' counts meet in the task that fits; the driver gets the
    weights alone. Without any rated text there is nothing to learn from, and the model is None.
    """
    sample = (
        rated.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
        .select("doc_id", F.col("grade").cast("long"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(max_rows)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                of, place, value, style = features(batch.column("text"))
                order = np.argsort(of, kind="stable")
                ends = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(style)))).astype(np.int32))
                styles = pa.array(np.arange(0, style.size + 1, STYLE).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("grade"),
                        pa.ListArray.from_arrays(ends, pa.array(place[order].astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(value[order].astype(np.float32))),
                        pa.ListArray.from_arrays(styles, pa.array(style.ravel())),
                    ],
                    names=["grade", "place", "value", "style"],
                )

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        taken = lambda name: pa.concat_arrays([batch.column(name) for batch in parts])
        grade, style = taken("grade").to_numpy(), taken("style").flatten().to_numpy().reshape(-1, STYLE)
        place, value = taken("place"), taken("value").flatten().to_numpy()
        of = np.repeat(np.arange(len(place), dtype=np.int32), place.value_lengths().to_numpy())
        place = place.flatten().to_numpy()
        parts.clear()
        model = fit(of, place, value, style, grade, grades)
        row = {"places": np.flatnonzero(model.index >= 0).astype(np.int32)} | {f: getattr(model, f) for f in ("rarity", "weights", "thresholds", "centre", "spread")}
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row.values()], names=list(row))

    schema = "grade long, place array<int>, value array<float>, style array<double>"
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("grade", "text").mapInArrow(count, schema)
    fitted = materialize(rows, "counts").coalesce(1).mapInArrow(fit_all, FITTED).toArrow().to_pylist()
    return model_of(fitted[0]) if fitted else None


def rate(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """``docs`` with expected_grade and p_top, the chance of the highest grade.

    Every row gets both: a null text, and one without words, is rated by its style of zeros. The texts
    are read whole, extra columns stay. Without a model both are null.
    """
    if model is None:
        names = [f for f in docs.columns if f not in ("expected_grade", "p_top")]
        return docs.select(*names, *(F.lit(None).cast("double").alias(name) for name in ("expected_grade", "p_top")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f for f in docs.columns if f not in ("expected_grade", "p_top")]
    given = docs.select(names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, column):
                tails = shared.value.tails(scores(shared.value, batch.column(column)))
                yield batch.append_column("expected_grade", pa.array(tails.sum(axis=1))).append_column("p_top", pa.array(tails[:, -1]))

    added = [T.StructField(name, T.DoubleType()) for name in ("expected_grade", "p_top")]
    return given.mapInArrow(score, T.StructType([*given.schema.fields, *added]))


#: Grades of the ratings: harmful, poor, good.
GRADES = 3


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade from doc_id, quality (0 or 1) and toxic (0 or 1): 0 if toxic, 1 if not good, 2 if good.

    A null toxic counts as 0; rows with a null quality have no grade unless they are toxic.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select(F.col("doc_id").cast("long"), grade.alias("grade"))
