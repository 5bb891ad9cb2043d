"""Exact top-k by inner product with paged metric trees (M-trees) and best-first search.

A vector ``x`` gets one more component ``sqrt(m - |x|^2)``, where ``m`` is the largest squared length,
and a query a zero. Then ``d(q, x)^2 = |q|^2 + m - 2 q.x``: the nearest vectors are those of the highest
inner product, and the triangle inequality holds. The vectors are dealt to cells around pivots, large
cells to several shards, and each shard is a tree of pages. A page holds for its entries the distance
to the page's own centre, and a covering radius for each child, so that most distances of a search need
not be computed once the k-th best score so far is known.

A query is first searched in a shard of its own cell. Its k-th score there goes with it to all other
shards, which it visits in blocks of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import groups_of, materialize

PIVOTS = 64  # only say which shard is searched first and which vectors share a tree
FAN = 16
PAGE = 256
PAGES = "shard long, page int, leaf boolean, ids binary, vectors binary, away binary, radius binary"
HITS = "query_id long, vec_id long, score long"


def scaled(embedding: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null where the vector or a component is null or not finite."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(finite, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)))


def _longs(*values: int) -> list[Column]:
    return [F.lit(v).cast("long") for v in values]


def _matrix(values: pa.Array | pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(values), dims), np.int64)
    for row, value in enumerate(values):
        value = value.as_py() if isinstance(value, pa.Scalar) else value
        out[row, : len(value)] = value
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(axis=1)


def _augmented(x: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(most - _lengths(x), 0.0))])


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def build_pages(ids: np.ndarray, vectors: np.ndarray, most: float) -> list[tuple]:
    """The pages of one tree, page 0 the root: (page, leaf, ids, vectors, distances to the centre, radii)."""
    points = _augmented(vectors, most)
    pages: list[tuple] = []

    def build(rows: np.ndarray, centre: np.ndarray) -> tuple[int, float]:
        away = _distances(points[rows], centre)
        page = len(pages)
        if len(rows) <= PAGE:
            pages.append((page, True, ids[rows], vectors[rows], away, np.empty(0)))
            return page, float(away.max())
        pages.append(())
        centres = points[rows[:: len(rows) // FAN][:FAN]]
        nearest = np.argmin(np.stack([_distances(points[rows], c) for c in centres]), axis=0)
        if (np.bincount(nearest) > 0.9 * len(rows)).any():  # many equal vectors: cut them by their order
            nearest = np.arange(len(rows)) * FAN // len(rows)
        children, radii, used = [], [], []
        for at in np.unique(nearest):
            own = rows[nearest == at]
            centre_at = centres[at] if at < len(centres) else points[own[0]]
            child, radius = build(own, centre_at)
            children.append(child)
            radii.append(radius)
            used.append(centre_at)
        used = np.stack(used)
        pages[page] = (page, False, np.array(children), used, _distances(used, centre), np.array(radii))
        return page, float(away.max())

    if len(ids):
        build(np.arange(len(ids)), points.mean(axis=0))
    return pages


def search(pages: dict, query: np.ndarray, own: int | None, k: int, least: float, most: float) -> list[tuple[int, int]]:
    """The best k of one tree as (score, -id), best last, of at least the score ``least``; not id ``own``."""
    length = float((query.astype(np.float64) ** 2).sum())
    start = np.append(query.astype(np.float64), 0.0)
    best: list[tuple[int, int]] = []  # heap of (score, -id): the worst first
    exact = query.astype(np.float64) if most < 2**52 and length < 2**52 else query

    def reach() -> float:
        """No farther vector can matter. A little wide, so that rounding loses none."""
        floor = max(least, best[0][0]) if len(best) == k else least
        if floor == -np.inf:
            return np.inf
        square = length + most - 2.0 * floor
        return np.sqrt(max(square, 0.0) + 1e-9 * (length + most) + 1e-6) * (1 + 1e-9)

    heap = [(0.0, 0, -1.0)]  # (least distance, page, distance of the query to the page's centre)
    while heap:
        near, page, to_centre = heapq.heappop(heap)
        limit = reach()
        if near > limit:
            break
        leaf, ids, vectors, away, radii = pages[page]
        bound = 0.0 if leaf else radii
        maybe = np.abs(to_centre - away) - bound <= limit if to_centre >= 0 else np.ones(len(ids), bool)
        at = np.flatnonzero(maybe)
        if not len(at):
            continue
        if leaf:
            scores = vectors[at] @ exact
            if len(best) == k or least != -np.inf:
                floor = max(least, best[0][0]) if len(best) == k else least
                keep = scores >= floor
                at, scores = at[keep], scores[keep]
            if len(at) > k + 1:  # all that tie with the (k+1)-th stay; one of them may be the query itself
                cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                at, scores = at[scores >= cut], scores[scores >= cut]
            for score, vec_id in zip(scores.tolist(), ids[at].tolist()):
                if vec_id == own:
                    continue
                item = (int(score), -vec_id)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        else:
            to = _distances(vectors[at], start)
            for child, distance, radius in zip(ids[at].tolist(), to.tolist(), radii[at].tolist()):
                if distance - radius <= limit:
                    heapq.heappush(heap, (max(0.0, distance - radius), child, distance))
    return sorted(best)


def _load(rows: pd.DataFrame, dims: int) -> dict:
    pages = {}
    for r in rows.itertuples():
        kind, width = (np.int64, dims) if r.leaf else (np.float64, dims + 1)
        ids = np.frombuffer(r.ids, np.int64)
        pages[r.page] = (
            r.leaf, ids, np.frombuffer(r.vectors, kind).reshape(len(ids), width),
            np.frombuffer(r.away, np.float64), np.frombuffer(r.radius, np.float64),
        )
    return pages


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, rows_per_shard: int = 4096, queries_per_block: int = 1024
) -> DataFrame:
    """For each query its ``k`` vectors of the highest inner product: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` have vec_id (long) and x (array of long, as from :func:`scaled`). A query
    does not find the vectors of its own id. Ties go to the smaller vec_id. Rows with a null id or
    vector take no part; vectors of unequal lengths are filled with zeros. With fewer than ``k``
    others a query gets all of them, with none it gets no row. Repeated rows of ``vectors`` each count.
    Scores are exact while products and their sums fit 63 bits.
    """
    spark = vectors.sparkSession
    vectors = vectors.where("vec_id IS NOT NULL AND x IS NOT NULL").select("vec_id", "x")
    queries = queries.where("vec_id IS NOT NULL AND x IS NOT NULL").select("vec_id", "x")
    square = F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    figures = vectors.unionAll(queries).agg(
        F.max(F.size("x")).alias("dims"), F.max(square).alias("most"), F.count("*").alias("n")
    ).first()
    if not figures["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims, most = figures["dims"], figures["most"]
    first = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("x").collect()
    pivots = _augmented(_matrix([r["x"] for r in first], dims), most) if first else np.zeros((1, dims + 1))

    def with_cell(df: DataFrame) -> DataFrame:
        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _augmented(_matrix(batch.column("x").to_pylist(), dims), most)
                cell = np.argmin(np.stack([_distances(points, p) for p in pivots]), axis=0)
                yield batch.append_column("cell", pa.array(cell.astype(np.int64)))

        return df.mapInArrow(cells, "vec_id long, x array<bigint>, cell long")

    placed = materialize(with_cell(vectors), "vectors")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # PIVOTS rows at most
    parts = [groups_of(counts.get(c, 0), rows_per_shard) if c in counts else 0 for c in range(len(pivots))]
    before = [0, *np.cumsum(parts).tolist()]
    shards = before[-1]
    part = F.array(*map(F.lit, parts))[F.col("cell").cast("int")]
    base = F.array(*map(F.lit, before))[F.col("cell").cast("int")].cast("long")
    # Not by the id alone: repeated rows of one id are dealt to all shards of their cell.
    placed = placed.withColumn("shard", base + F.pmod(F.xxhash64("vec_id"), F.greatest(part, F.lit(1))))

    def trees(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = build_pages(rows["vec_id"].to_numpy(np.int64), _matrix(rows["x"], dims), most)
        return pd.DataFrame(
            [
                (key[0], p, leaf, i.astype(np.int64).tobytes(), np.ascontiguousarray(v).tobytes(), a.tobytes(), r.tobytes())
                for p, leaf, i, v, a, r in found
            ],
            columns=["shard", "page", "leaf", "ids", "vectors", "away", "radius"],
        )

    pages = materialize(placed.groupBy("shard").applyInPandas(trees, PAGES), "pages")

    def find(key: tuple, tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(tree) and len(asked):
            loaded = _load(tree, dims)
            for q in asked.itertuples():
                vector = np.zeros(dims, np.int64)
                vector[: len(q.x)] = q.x
                least = -np.inf if pd.isna(q.least) else float(q.least)
                found += [(q.vec_id, -i, s) for s, i in search(loaded, vector, q.vec_id, k, least, most)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    asked = with_cell(queries)
    asked = asked.withColumn(
        "home", F.when(part > 0, base + F.pmod(F.xxhash64("vec_id"), F.greatest(part, F.lit(1)))).otherwise(-1)
    )
    asked = materialize(asked.withColumn("least", F.lit(None).cast("long")), "queries")
    blocks = groups_of(asked.count(), queries_per_block)
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    both = ["shard", "block"]
    paged = pages.withColumn("block", F.explode(F.sequence(*_longs(0, blocks - 1))))

    def searched(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("block", block).select(*both, "vec_id", "x", "least")
        return paged.groupBy(*both).cogroup(rows.groupBy(*both)).applyInPandas(find, HITS)

    home = materialize(searched(asked.withColumn("shard", F.col("home"))), "hits")
    least = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounded = asked.drop("least").join(
        least.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "least"), "vec_id", "left"
    )
    hits = home
    if shards > 1:
        everywhere = bounded.withColumn("shard", F.explode(F.sequence(*_longs(0, shards - 1))))
        hits = home.unionByName(searched(everywhere.where("shard <> home")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
