"""Where two tokenizers cut the same bytes alike, and how often each pair of their tokens overlaps.

Both token rows of a text cut the same bytes. Where both have a cut, a group ends. Between two cuts of
either, one token of each overlaps: these are the links. Most groups are one token of A and one of B with the
same bytes, and for those an array from A's ids to B's ids says all: they are counted in a vector as long as
A's vocabulary. Only the links of other groups are pairs that are shuffled to be counted.

A block is a chunk of documents. It has each of its irregular pairs once, with how many links hold it;
a document keeps places in that list. So corpus-wide counts come back to a block as one list, not as a row for each link.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm import tokens
from tallybrook.llm.common import chunks, materialize

BLOCK_BYTES = 4 << 20
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = pa.schema(
    [("block", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in FIGURES]
    + [("groups_sha256", pa.string()), ("plain", pa.binary()), ("odd", pa.binary()), ("odd_bytes", pa.int32())]
)
ALIGNED_DDL = (
    "block long, pairs array<bigint>, counts array<bigint>, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, plain binary, odd binary, odd_bytes int"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Two vocabularies: a byte-level one (A, of base64 tokens and ranks) and one of pieces (B)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.path_a, self.pieces = path_a, sentencepiece.SentencePieceProcessor(model_file=path_b)
        known = tokens.encoder(path_a)
        self.bytes_a = [known.decode_single_token_bytes(i) for i in range(known.n_vocab)]
        self.bytes_b = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.kind_a = "<u2" if self.size_a <= 1 << 16 else "<u4"
        self.length_a = np.fromiter(map(len, self.bytes_a), np.int64, self.size_a)
        self.length_b = np.fromiter(map(len, self.bytes_b), np.int64, self.size_b)
        # Where a byte and a piece are the same, text is cut into the piece.
        of_bytes = {b: i for i, b in sorted(enumerate(self.bytes_b), key=lambda x: not self.pieces.is_byte(x[0]))}
        self.same = np.fromiter((of_bytes.get(a, -1) for a in self.bytes_a), np.int64, self.size_a)
        # What stands for a token in the text of the groups: its id, and what follows it there.
        self.names = [b"%d%s" % (i, end) for i in range(self.size_a) for end in (b",", b"|")]
        self.names += [b"%d%s" % (i, end) for i in range(self.size_b) for end in (b",", b";")]

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of space+text by A and of the text by B; None where there is no text or its bytes are not kept."""
        if not text:
            return None
        raw = f" {text}".encode()
        a = tokens.encode(f" {text}", self.path_a)
        b = self.pieces.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return a.astype(np.int64), np.array(b, np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * self.size_b + b


@functools.lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Pair:
    """One for each Python worker."""
    return Pair(path_a, path_b)


class Links:
    """The groups and links of texts in a row; their ids by A and by B cover the same bytes."""

    def __init__(self, both: Pair, a: list[np.ndarray], b: list[np.ndarray]):
        n_a, n_b = (np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int64) for rows in (a, b))
        a, b = (np.concatenate(rows) if rows else np.empty(0, np.int64) for rows in (a, b))
        ends_a, ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
        cut = np.zeros((int(ends_a[-1]) if len(a) else 0) + 1, np.uint8)
        cut[ends_a] = 1
        cut[ends_b] |= 2
        at = np.flatnonzero(cut)  # the end of each link
        by_a, by_b = (cut[at] & 1).astype(np.int64), (cut[at] >> 1).astype(np.int64)
        both_end = by_a & by_b
        upto = np.cumsum(both_end)
        group = upto - both_end
        #: Of each link: the ids on both sides, and whether it is a group of its own with the same bytes on both sides.
        self.a, self.b = a[np.cumsum(by_a) - by_a], b[np.cumsum(by_b) - by_b]
        links_of = np.bincount(group, minlength=1)
        self.plain = (links_of[group] == 1) & (both.same[self.a] == self.b)
        group_a, group_b = group[by_a > 0], group[by_b > 0]
        #: Of each text: where its tokens and links begin and end.
        self.n_a, self.n_b = n_a, n_b
        ends = np.concatenate(([0], ends_a))[n_a]
        self.links = np.searchsorted(at, ends, "right")
        self.groups = np.concatenate(([0], upto))[self.links]
        # Tokens in the order of the groups' text: those of A before those of B in each group.
        n_groups = int(upto[-1]) if len(upto) else 0
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=n_groups))))
        upto_a = np.cumsum(np.bincount(group_a, minlength=n_groups))
        self.order = np.empty(len(a) + len(b), np.int64)
        self.order[np.arange(len(a)) + before_b[group_a]] = 2 * a + both_end[by_a > 0]
        self.order[np.arange(len(b)) + upto_a[group_b]] = 2 * (both.size_a + b) + both_end[by_b > 0]

    def digest(self, both: Pair, i: int) -> str:
        """Of the groups of text ``i``, written ``a1,a2|b1;a3|b2,b3``."""
        own = self.order[self.n_a[i] + self.n_b[i] : self.n_a[i + 1] + self.n_b[i + 1]].tolist()
        return hashlib.sha256(b"".join(map(both.names.__getitem__, own))[:-1]).hexdigest()


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=ALIGNED)


def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ALIGNED, written already: of documents, of blocks, and of what a task has counted by A's ids.

    A row with ``pairs`` and ``counts`` says how many links hold a pair; with a ``block`` they are that block's
    irregular ones, in the order to which its documents' ``odd`` refer. ``plain`` are the ids of A in groups of one and one.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(path_a, path_b)
        counted = np.zeros(both.size_a, np.int64)
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in chunks(whole, "text", block_bytes):
                rows, held, a, b = [], [], [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    row = dict.fromkeys(FIGURES, 0) | {"block": block, "doc_id": doc_id, "groups_sha256": "", "plain": b"", "odd": b""}
                    if ids := both.encode(text.as_py()):
                        a.append(ids[0])
                        b.append(ids[1])
                        held.append(row)
                    rows.append(row)
                links = Links(both, a, b)
                counted += np.bincount(links.a[links.plain], minlength=both.size_a)
                odd = np.flatnonzero(~links.plain)
                pairs, place, counts = np.unique(both.pair(links.a[odd], links.b[odd]), return_inverse=True, return_counts=True)
                kind = np.dtype("<u2" if len(pairs) <= 1 << 16 else "<u4")
                place = place.astype(kind)
                for i, row in enumerate(held):
                    low, high = links.links[i : i + 2]
                    odd_low, odd_high = np.searchsorted(odd, (low, high))
                    row |= {
                        "n_a": links.n_a[i + 1] - links.n_a[i], "n_b": links.n_b[i + 1] - links.n_b[i], "n_links": high - low,
                        "n_groups": links.groups[i + 1] - links.groups[i], "groups_sha256": links.digest(both, i), "odd_bytes": kind.itemsize,
                        "plain": links.a[low:high][links.plain[low:high]].astype(both.kind_a).tobytes(),
                        "odd": place[odd_low:odd_high].tobytes(),
                    }
                yield _rows(rows)
                if len(pairs):
                    yield _rows([{"block": block, "pairs": pairs, "counts": counts}])
                block += 1
        some = np.flatnonzero(counted)
        if len(some):
            yield _rows([{"pairs": both.pair(some, both.same[some]), "counts": counted[some]}])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(scan, ALIGNED_DDL), "aligned")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): each pair of ids that links hold, how many, and whether no other of its B id has more."""
    each = aligned.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counted = materialize(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")), "pairs")
    b = F.pmod("pair", F.lit(size_b))
    most = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # a row for each id of a vocabulary
    return counted.join(F.broadcast(most), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row of RESULT for each row of ``docs``, by the vocabularies in the two files.

    ``n_best`` of a document's links hold a pair that is the most frequent of its B id in the whole
    table, ties included; ``count_sum`` adds up how often the table has each link's pair. Null and empty texts, and those that
    either vocabulary does not give back byte by byte, have no tokens: zeros and an empty digest. Repeated rows and null
    ids keep rows of their own; other columns are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path_a, path_b = path_a or tokens.default_vocabulary(), path_b or default_pieces()
    both = vocabularies(path_a, path_b)
    aligned = align(docs, path_a, path_b, block_bytes)
    scored = materialize(pair_counts(aligned, both.size_b), "pairs-scored")

    # As many entries as A has ids: bounded by the vocabulary, whatever the corpus.
    ids = np.flatnonzero(both.same >= 0)
    plain_pairs = spark.createDataFrame(pd.DataFrame({"a": ids, "pair": both.pair(ids, both.same[ids])}))
    found = scored.join(F.broadcast(plain_pairs), "pair").select("a", "n", "best").toPandas()
    plain_n, plain_best = np.zeros(both.size_a, np.int64), np.zeros(both.size_a, np.int64)
    plain_n[found["a"]], plain_best[found["a"]] = found["n"], found["best"]
    kind_a = both.kind_a

    def judge(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        n, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        n[known["place"]], best[known["place"]] = known["n"], known["best"]
        sums, bests = [], []
        for plain, odd, odd_bytes in zip(own["plain"], own["odd"], own["odd_bytes"]):
            a = np.frombuffer(plain, kind_a)
            o = np.frombuffer(odd, f"<u{int(odd_bytes)}") if odd else np.empty(0, np.int64)
            sums.append(int(plain_n[a].sum() + n[o].sum()))
            bests.append(int(plain_best[a].sum() + best[o].sum()))
        return own.assign(n_best=bests, count_sum=sums)[[field.split()[0] for field in RESULT.split(", ")]]

    listed = aligned.where("block IS NOT NULL AND pairs IS NOT NULL").select(
        F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair")
    )
    known = listed.join(scored, "pair").select("of_block", "place", "n", "best")
    own = aligned.where("pairs IS NULL").drop("pairs", "counts")
    return own.groupBy("block").cogroup(known.groupBy("of_block")).applyInPandas(judge, RESULT)
