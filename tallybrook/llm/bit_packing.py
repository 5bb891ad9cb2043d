"""Token ids in files of fixed-width bits: no id takes more than the vocabulary needs.

A file is a row of blocks, then a table of where each block begins and how many ids it holds, then a
footer of fixed size. In a block 64 ids fill as many 64-bit words as an id has bits, so packing and
unpacking are 64 shifts of whole numpy columns, whatever the width. Any run of ids is read by the blocks it is in alone.
Ids lie in ascending order of doc_id over files and inside them.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import chunks, materialize
from tallybrook.llm.words import split_words
from tallybrook.session import shared_folder

LANES = 64  # ids that fill whole words together
BLOCK_IDS = 1 << 16
READ_IDS = 1 << 20  # ids unpacked at once
CACHED_WORDS = 1 << 20  # some 150 bytes each
END_ID = 1
CHUNK_BYTES = 16 << 20  # of text at once: the larger, the fewer words are looked up again
#: Words that the vocabulary cuts between letters and the rest, and nowhere else before it merges; how many are encoded together.
SIMPLE = re.compile(rb"[A-Za-z]+[.,;:!?]*")
JOINED = 1000
UNIT_END = "</w>"  # fixed value: how the vocabulary marks the last token of a unit
MAGIC = b"IDBITS01"
FOOTER = "<8sIIQQ"  # magic, bits of an id, ids of a block, blocks, ids


def bits_of(vocabulary: int) -> int:
    """Bits that the largest id of so many takes."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids one after the other, the lowest bit first, filled up with zeros to a multiple of 64 ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    rows = -(-len(ids) // LANES)
    lanes = np.zeros((rows, LANES), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((rows, bits), np.uint64)
    for lane in range(LANES):
        at, shift = divmod(lane * bits, 64)
        words[:, at] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, at + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of :func:`pack_bits`, as unsigned 32-bit numbers."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes = np.empty((len(words), LANES), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(LANES):
        at, shift = divmod(lane * bits, 64)
        value = words[:, at] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, at + 1] << np.uint64(64 - shift)
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[:count]


class PackedWriter:
    """Writes ids to an open file, block by block; no more than a block and what is added is held."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        if block_ids % LANES:
            raise ValueError(f"a block must hold a multiple of {LANES} ids")
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.held, self.n_held, self.blocks, self.at, self.n_ids = [], 0, [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            self._flush(self.n_held // self.block_ids * self.block_ids)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for a in range(0, count, self.block_ids):
            block = ids[a : min(a + self.block_ids, count)]
            data = pack_bits(block, self.bits)
            self.blocks.append((self.at, len(block)))
            self.out.write(data)
            self.at += len(data)
        self.held, self.n_held = [ids[count:].copy()], len(ids) - count  # a view would keep all ids

    def close(self) -> None:
        """The rest of the ids, the table of blocks and the footer; the file itself stays open."""
        self._flush(self.n_held)
        self.out.write(np.array(self.blocks, "<u8").tobytes())
        self.out.write(struct.pack(FOOTER, MAGIC, self.bits, self.block_ids, len(self.blocks), self.n_ids))


@dataclass
class PackedFile:
    """Random access to a file of :class:`PackedWriter`; only the table of blocks is held."""

    source: pa.NativeFile
    bits: int
    block_ids: int
    offsets: np.ndarray
    n_ids: int

    @classmethod
    def open(cls, uri: str) -> PackedFile:
        store, name = filesystem(uri)
        source = store.open_input_file(name)
        size, tail = source.size(), struct.calcsize(FOOTER)
        magic, bits, block_ids, n_blocks, n_ids = struct.unpack(FOOTER, source.read_at(tail, size - tail))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no file of packed ids")
        table = source.read_at(16 * n_blocks, size - tail - 16 * n_blocks)
        return cls(source, bits, block_ids, np.frombuffer(table, "<u8").reshape(-1, 2)[:, 0].astype(np.int64), n_ids)

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, from the blocks that hold them."""
        if start < 0 or start + count > self.n_ids:
            raise IndexError(f"ids {start} to {start + count} of {self.n_ids}")
        if not count:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        own = min((last + 1) * self.block_ids, self.n_ids) - first * self.block_ids
        n_bytes = -(-own // LANES) * self.bits * 8
        ids = unpack_bits(self.source.read_at(n_bytes, int(self.offsets[first])), self.bits, own)
        skipped = start - first * self.block_ids
        return ids[skipped : skipped + count]


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts by a vocabulary that drops white space, from the ids of their words.

    The vocabulary's rules cut a text at white space before anything is merged, and what they do
    before that looks at no more than a word, so the ids of a text are those of its words in a row. Each
    different word is encoded once and remembered; what is remembered is emptied when it has grown to ``CACHED_WORDS``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.is_end = np.zeros(self.size, bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(UNIT_END)]] = True
        self._forget()

    def _forget(self) -> None:
        """Words to their numbers, and in the order of these how many ids each has, where they begin, and all ids."""
        self.known, self.length, self.begin, self.ids = {}, np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint32)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; those not known yet are encoded."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHED_WORDS:
            self._forget()
            new = words
        if new:
            simple, others = [], []
            for word in new:
                (simple if SIMPLE.fullmatch(word) else others).append(word)
            for words_of, encode in ((simple, self._together), (others, self._each)):
                ids, length = encode(words_of)
                self.begin = np.append(self.begin, (len(self.ids) + np.cumsum(length) - length).astype(np.int32))
                self.length = np.append(self.length, length.astype(np.int32))
                self.ids = np.append(self.ids, ids)
                self.known.update(zip(words_of, range(len(self.known), len(self.length))))
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def _each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each word has."""
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        ids = [e.ids for e in encoded]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(length.sum())), length

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of SIMPLE words, many at a time: letters are one unit of the vocabulary, and what follows them another."""
        lines = [b" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids, _ = self._each(lines)
        units = np.cumsum([1 + (not w[-1:].isalpha()) for w in words])
        ends = np.append(0, np.flatnonzero(self.is_end[ids]) + 1)  # after each unit
        return ids, np.diff(ends[np.append(0, units)]) if words else np.empty(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each text begin (one more entry: the end). A null text has none."""
        codes, starts, different = split_words(texts)
        number = self._numbers(different.to_pylist())
        per_word = self.length[number][codes]
        ends = np.concatenate(([0], np.cumsum(per_word)))
        # Places in self.ids: 32 bits are enough, since all texts of a batch and the words remembered have fewer ids than 2^31.
        places = np.repeat(self.begin[number][codes] - ends[:-1].astype(np.int32), per_word)
        places += np.arange(len(places), dtype=np.int32)
        return self.ids[places], ends[starts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(path)


INDEX = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())]
)


def write_packed(
    docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Files of packed ids below ``folder``, in ascending order of doc_id; returns their index, written already.

    The index has ``part`` (the order of the files), ``file``, ``doc_id``, ``at`` (the document's first id in its
    file) and ``n_tokens``, with the end id. A null text is an empty one. Null ids come first; rows of one id, repeated
    rows too, are documents of their own in the order of the table. A file bears the number of
    the attempt that wrote it, and the index names those of the attempts that were committed, so a task
    that runs twice, or at the same time as its twin, does no harm. ``folder`` must be seen by all executors.
    """
    path = vocabulary or default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, ids_of = TaskContext.get(), encoder(path)
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        name = f"ids-{context.partitionId():06d}-{context.taskAttemptId()}.bits"
        at = 0
        with store.open_output_stream(f"{root}/{name}") as out:
            writer = PackedWriter(out, bits_of(max(ids_of.size, end_id + 1)), block_ids)
            for whole in batches:
                for batch in chunks(whole, "text", CHUNK_BYTES):
                    ids, starts = ids_of.encode(batch.column("text"))
                    ids = np.insert(ids, starts[1:], end_id)
                    lengths = np.diff(starts) + 1
                    begins = at + np.cumsum(lengths) - lengths
                    writer.add(ids)
                    at += len(ids)
                    n = batch.num_rows
                    columns = [np.full(n, context.partitionId(), np.int32), [name] * n, batch.column("doc_id"), begins, lengths]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, INDEX.types)], schema=INDEX)
            writer.close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("place"))
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    return materialize(ordered.mapInArrow(write, "part int, file string, doc_id long, at long, n_tokens long"), "ids-index")


def read_packed(index: DataFrame, folder: str, read_ids: int = READ_IDS) -> DataFrame:
    """``index`` with ``ids_crc32``, the checksum of each document's ids as read back from the files in ``folder``.

    Documents are dealt to tasks by the place of their ids, so that one read serves neighbours; a task
    holds ``read_ids`` ids and, of a longer document, as much at a time.
    """
    fields = INDEX.append(pa.field("ids_crc32", pa.int64()))
    parts = max(index.select("file").distinct().count(), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            sums = []
            held, low = np.empty(0, np.uint32), 0
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if file != name:
                    opened, name, held = PackedFile.open(f"{folder}/{file}"), file, np.empty(0, np.uint32)
                crc = 0
                for a in range(at, at + n, read_ids):
                    b = min(a + read_ids, at + n)
                    if not (low <= a and b <= low + len(held)):
                        held, low = opened.read(a, min(read_ids, opened.n_ids - a)), a
                    crc = zlib.crc32(held[a - low : b - low].astype("<u4", copy=False).tobytes(), crc)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], schema=fields)

    near = F.floor(F.col("at") / read_ids)
    dealt = index.repartition(parts, "file", near).sortWithinPartitions("part", "at")
    return dealt.mapInArrow(read, "part int, file string, doc_id long, at long, n_tokens long, ids_crc32 long")


def document_ids(docs: DataFrame, vocabulary: str | None = None, folder: str | None = None, **options) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row of ``docs``, by way of packed files.

    ``start`` counts the ids of all documents before. The order and the cases of nulls, repeated rows and empty
    texts are those of :func:`write_packed`; an empty table gives no rows.
    """
    folder = folder or shared_folder(docs.sparkSession, "packed-ids")
    index = write_packed(docs, folder, vocabulary, **options)
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One number a file is scanned.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    found = read_packed(index, folder).join(before, "part")
    return found.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
