"""Word n-gram Jaccard join with parity sketches.

A document's set of n-grams is hashed to a string of bits: each member flips one bit. Members that two
sets share flip the same bits, so the sketches differ in no more bits than the sets differ in members.
Sets of a Jaccard similarity of ``t`` differ in at most ``(1 - t) / (1 + t)`` of their sizes' sum. Cut
into one block more than that, two sketches must agree in a whole block. Documents that share a
block are candidates, and the sets themselves decide.

An empty block says nothing, and many documents share it. So there are a few blocks more, the spare
ones, and a sketch leaves out its empty blocks unless they are more than that. At least one block more
than the spare ones agrees, and those that agree are empty on both sides or on neither.

How many blocks there are follows from the size, so sizes are banded: a document is entered for its
own band and the next one, which holds every larger document that can be similar.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import xor

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.llm.common import chunks, groups_of, materialize
from tallybrook.llm.components import components
from tallybrook.llm.repeats import NO_ID, keyed
from tallybrook.llm.words import mix, shingle_sets

TILE = 512  # members of a group that a task compares with as many others
WIDTH = 1 << 20  # bits of a block; only those that are set are kept
SKETCH = "doc_id long, text_key long, n_shingles long, node long, keys array<bigint>, held binary"


@lru_cache(maxsize=None)
def bands(num: int, den: int, most: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """The largest size of each band, and its number of blocks, for a similarity of ``num / den``."""
    tops, blocks, low = [], [], 1
    t = num / den
    empty = float(np.exp(-t * t * (1 + t) / (2 * (1 - t)))) if num < den else 0.0  # of the blocks, at most
    while low <= most:
        top = low * den // num  # the largest set that can be similar to the smallest one of the band
        tops.append(top)
        needed = 2 * top * (den - num) // (den + num) + 1
        blocks.append(needed + (int(1.6 * empty * needed) + 1 if needed > 1 else 0))
        low = top + 1
    return np.array(tops), np.array(blocks)


def block_keys(members: np.ndarray, num: int, den: int) -> np.ndarray:
    """A 64-bit key for each block of the sketches of the set's own and the next band."""
    tops, blocks = bands(num, den)
    own = int(np.searchsorted(tops, len(members)))
    keys = []
    for band in (own, own + 1):
        count = int(blocks[band])
        block = ((members >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        place, times = np.unique(block * np.uint64(WIDTH) + (members & np.uint64(WIDTH - 1)), return_counts=True)
        odd = place[times & 1 == 1]  # the bits that are set
        of = odd // np.uint64(WIDTH)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(odd) else np.empty(0, np.int64)
        values = np.zeros(count, np.uint64)
        if len(odd):
            values[of[first].astype(np.int64)] = np.bitwise_xor.reduceat(mix(odd + np.uint64(1)), first)
        place = np.uint64(band << 40) + np.arange(count, dtype=np.uint64)
        found = mix(values ^ mix(place + np.uint64(1)))
        bare = np.bincount(block.astype(np.int64), minlength=count) == 0
        needed = 2 * int(tops[band]) * (den - num) // (den + num) + 1
        keys.append(found[~bare] if bare.sum() <= count - needed else found)
    return np.concatenate(keys).view(np.int64)


def sketches(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, node (a hash of the whole set; null if empty), the block keys and the parity sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                sets = shingle_sets(batch.column("text"), n)
                nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
                keys = [block_keys(s, num, den) if len(s) else np.empty(0, np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
                        pa.array([_parities(s) for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "node", "keys", "held"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), F.col("text").cast("string"))
    return given.mapInArrow(sketch, SKETCH)


def _verified(texts: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b and more) with ``linked``: whether the sets of the two nodes' texts are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text_b"):
                left, code = np.unique(batch.column("a").to_numpy(), return_index=True)
                ours = dict(zip(left.tolist(), shingle_sets(batch.column("text_a").take(pa.array(code)), n)))
                linked = []
                for a, theirs in zip(batch.column("a").to_pylist(), shingle_sets(batch.column("text_b"), n)):
                    both = len(np.intersect1d(ours[a], theirs, assume_unique=True))
                    linked.append(den * both >= num * (len(ours[a]) + len(theirs) - both))
                yield batch.drop_columns(["text_a", "text_b"]).append_column("linked", pa.array(linked, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(two, "b").select(*pairs.columns, "text_a", "text_b")
    return rows.mapInArrow(compare, T.StructType([*pairs.schema.fields, T.StructField("linked", T.BooleanType())]))


def _parities(members: np.ndarray) -> bytes:
    """A parity sketch of 8 to 16 bits for each member."""
    width = max(64, 1 << (8 * len(members)).bit_length())
    held = np.bincount((mix(members) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((held & 1).astype(np.uint8)).tobytes()


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """node, size and held: the whole set of the text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for full in batches for part in chunks(full, "text")):
            sets = shingle_sets(batch.column("text"), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "size", "held"],
            )

    return texts.select("node", "text").mapInArrow(describe, "node long, size long, held binary")


def _allowed(pairs: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sketches (node, size, held) do not rule out that they are similar."""

    def bits_apart(x: bytes, y: bytes) -> int:
        width = min(len(x), len(y))
        parts = (z[k : k + width] for z in (x, y) for k in range(0, len(z), width))
        return reduce(xor, (int.from_bytes(part) for part in parts)).bit_count()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, *held = (batch.column(c).to_pylist() for c in ("total", "held_a", "held_b"))
            kept = [bits_apart(x, y) * (den + num) <= (den - num) * t for t, x, y in zip(total, *held)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    one, two = bits.toDF("a", "size_a", "held_a"), bits.toDF("b", "size_b", "held_b")
    sizes = pairs.join(one, "a").join(two, "b").where(den * F.least("size_a", "size_b") >= num * F.greatest("size_a", "size_b"))
    return sizes.select("a", "b", (F.col("size_a") + F.col("size_b")).alias("total"), "held_a", "held_b").mapInArrow(judge, "a long, b long")


def _folded(bits: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of ``width`` bytes: the parts of a wider one are added without carry."""
    out = np.zeros((len(bits), width // 8), np.uint64)
    for i, b in enumerate(bits):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), axis=0)
    return out


def propose(rows: pd.DataFrame, num: int, den: int, whole: bool) -> list[tuple[int, int]]:
    """Pairs of nodes of different components that may be similar by their sketches, or are by their sets.

    ``rows`` has node, component, size and held, a sketch or the ``whole`` set. The pairs are a forest: if all
    of them link, every other pair that may link is connected too.
    """
    rows = rows.drop_duplicates("node").sort_values("node")
    columns = (rows[c].to_numpy() for c in ("node", "size", "held", "component"))
    return _proposed(*columns, num, den, whole)


def _proposed(node: np.ndarray, size: np.ndarray, held: np.ndarray, component: np.ndarray, num: int, den: int, whole: bool) -> list[tuple[int, int]]:
    """:func:`propose` for different nodes in order."""
    label = np.unique(component, return_inverse=True)[1]
    if not len(label) or not label.any():
        return []
    node, size, held = node.tolist(), size.astype(np.int64), held.tolist()
    sets = [np.frombuffer(h, np.uint64) for h in held] if whole else None
    bits = [_parities(s) for s in sets] if whole else held
    sketch = _folded(bits, min(map(len, bits)))
    found = []
    for i in range(len(node) - 1):
        later = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(later):
            continue
        fits = den * np.minimum(size[later], size[i]) >= num * np.maximum(size[later], size[i])
        later = later[fits]
        apart = np.bitwise_count(sketch[later] ^ sketch[i]).sum(axis=1, dtype=np.int64)
        later = later[apart * (den + num) <= (den - num) * (size[later] + size[i])]
        for j in later.tolist():
            if label[j] == label[i]:
                continue
            if whole:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * both < num * (size[i] + size[j] - both):
                    continue
            found.append((node[i], node[j]))
            label[label == label[j]] = label[i]
    return found


def _rest(groups: DataFrame, found: DataFrame, held: DataFrame, num: int, den: int, whole: bool) -> DataFrame:
    """Proposed pairs (group, a, b) among the members of each group that are not connected yet.

    A group of at most TILE members is one tile. In others the members outside the component of the group's
    pivot are dealt to tiles of bounded size, and so are those inside. Two tiles of outside ones meet once, and
    each meets every inside one; a task never holds more than a few tiles, and pairs are compared inside it
    without being rows.
    """
    of = found.select("node", "component")
    pivot = of.select(F.col("node").alias("group"), F.col("component").alias("of_pivot"))
    named = (
        groups.join(of, "node", "left")
        .join(pivot, "group", "left")
        .select(
            "group", "node", F.coalesce("component", "node").alias("component"),
            (F.coalesce("component", "node") != F.coalesce("of_pivot", "group")).alias("outside"),
        )
    )
    of_each = lambda members: F.ceil(F.count_if(members) / TILE).cast("long")
    tiles = (
        named.groupBy("group")
        .agg(of_each(F.col("outside")).alias("n_out"), of_each(~F.col("outside")).alias("n_in"), (F.count("*") <= TILE).alias("one"))
        .where("n_out > 0")
        .withColumn("n_in", F.when(F.col("one"), 0).otherwise(F.col("n_in")))
    )
    own = named.join(tiles, "group").withColumn("outside", F.col("one") | F.col("outside"))
    own = own.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("outside"), F.col("n_out")).otherwise(F.col("n_in"))))
    # A tile is named by two numbers: those of two outside ones, or of an outside one and an inside one after them all.
    meets = F.when(
        F.col("outside"),
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n_out") + F.col("n_in") - 1),
            lambda t: F.struct(F.least(t, "own").alias("i"), F.greatest(t, "own").alias("j")),
        ),
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n_out") - 1),
            lambda t: F.struct(t.alias("i"), (F.col("n_out") + F.col("own")).alias("j")),
        )
    )
    dealt = own.withColumn("tile", F.explode(meets)).select("group", "tile.i", "tile.j", "node", "component")
    dealt = materialize(dealt, "tiles")
    buckets = groups_of(dealt.count(), 2 * TILE)

    def pick(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out, rows = [], part.drop_duplicates(["group", "i", "j", "node"]).sort_values(["group", "i", "j", "node"])
        tile = rows[["group", "i", "j"]].to_numpy()
        columns = [rows[c].to_numpy() for c in ("node", "size", "held", "component")]
        ends = np.append(np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1, len(rows))
        for low, high in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
            out += [(tile[low, 0], a, b) for a, b in _proposed(*(c[low:high] for c in columns), num, den, whole)]
        return pd.DataFrame(out, columns=["group", "a", "b"])

    bucket = F.pmod(F.xxhash64("group", "i", "j"), F.lit(buckets))
    rows = dealt.join(held, "node").groupBy(bucket.alias("bucket"))
    return rows.applyInPandas(pick, "group long, a long, b long")


def similar_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text).

    Two documents link if their sets of ``n`` words have a Jaccard similarity of ``num / den`` or more;
    A-Z is lower-cased. component_id is the smallest doc_id that links reach. A null text, and one
    without words, links with nothing. Copies are one node, not pairs. The candidates of a block are
    a group around its smallest node. First all that their sketches allow are compared with that, then those that are not
    connected yet with the others of the group, by their whole sketches inside the tasks; what these allow
    is verified. Where that fails the group is compared once more by whole sets. So no link that connects
    two components is lost, and the pairs of a large group are never rows. Rows of one doc_id are
    documents of their own with that number.
    """
    # Sets are equal if their 64-bit hashes are: of a billion different sets, two meet with 3 in 100.
    known = materialize(sketches(docs, n, num, den), "sketches")
    nodes = materialize(
        known.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text_key")).alias("of")),
        "nodes",
    )
    entries = known.where("node IS NOT NULL").select("node", F.explode("keys").alias("key"))
    # Entries are shuffled once: keys of one node alone are most of them, and a join would carry each of these a second time.
    of_key = Window.partitionBy("key")
    met = entries.select("node", F.min("node").over(of_key).alias("group"), F.max("node").over(of_key).alias("high"))
    groups = materialize(met.where("group < high").select("group", "node").distinct(), "groups")
    wanted = nodes.join(groups.select("node").distinct(), "node").select("node", "of.doc", "of.text_key")
    # One row of each node; those of one id are told apart by their text, and those without an id count too.
    texts = materialize(
        keyed(docs).join(wanted, ["doc", "text_key"]).select("node", "text").dropDuplicates(["node"]),
        "texts",
    )
    sketched = known.select("node", F.col("n_shingles").alias("size"), "held")
    bits = materialize(sketched.join(groups.select("node").distinct(), "node").dropDuplicates(["node"]), "bits")

    star = groups.where("group <> node").select(F.col("group").alias("a"), F.col("node").alias("b"))
    fits = materialize(_allowed(star, bits, num, den), "fits")
    links = materialize(_verified(texts, fits, n, num, den).where("linked"), "verified").select("a", "b")
    found = components(links)
    told = materialize(_verified(texts, _rest(groups, found, bits, num, den, whole=False), n, num, den), "verified")
    new = told.where("linked").select("a", "b")
    if not new.isEmpty():
        links = links.unionAll(new)
        found = components(links)
    failed = told.where("NOT linked").select("group").distinct()
    if not failed.isEmpty():
        # Sketches of these groups came too close; their sets decide.
        again = groups.join(failed, "group")
        sets = _sets(texts.join(again.select("node").distinct(), "node"), n)
        new = materialize(_rest(again, found, sets, num, den, whole=True).select("a", "b"), "verified")
        if not new.isEmpty():
            found = components(links.unionAll(new))
    own = nodes.join(found, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    lowest = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = own.join(lowest, "component").select("node", "component_id")
    return known.select("doc_id", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
