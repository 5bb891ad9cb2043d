import io
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import bit_packing

DOCS = "doc_id long, text string, part string, file string"


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 15, 16, 17, 24, 31, 32])
def test_round_trip_of_every_width(bits, tmp_path):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    ids[:2] = 0, (1 << bits) - 1
    for n in (0, 1, 63, 64, 65, 1000):
        data = bit_packing.pack_bits(ids[:n], bits)
        assert len(data) == -(-n // 64) * 8 * bits
        assert (bit_packing.unpack_bits(data, bits, n) == ids[:n]).all()
    (tmp_path / "x.bits").write_bytes(written(ids, bits))
    packed = bit_packing.PackedFile.open(f"file://{tmp_path}/x.bits")
    assert packed.n_ids == 1000 and packed.bits == bits
    for start, count in ((0, 1000), (0, 0), (1000, 0), (127, 2), (128, 128), (999, 1), (300, 511)):
        assert (packed.read(start, count) == ids[start : start + count]).all()
    with pytest.raises(IndexError):
        packed.read(999, 2)


def written(ids, bits):
    out = io.BytesIO()
    writer = bit_packing.PackedWriter(out, bits, block_ids=128)
    for a in range(0, len(ids), 77):
        writer.add(ids[a : a + 77])
    writer.close()
    return out.getvalue()


def test_what_does_not_fit_is_refused(tmp_path):
    with pytest.raises(ValueError):
        bit_packing.pack_bits(np.array([4], np.uint32), 2)
    with pytest.raises(ValueError):
        bit_packing.PackedWriter(io.BytesIO(), 3, block_ids=100)
    (tmp_path / "y.bits").write_bytes(bytes(64))
    with pytest.raises(ValueError):
        bit_packing.PackedFile.open(f"file://{tmp_path}/y.bits")
    assert [bit_packing.bits_of(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


TEXTS = [
    "Plain words, and MORE words.", "", "   \t\n", None, "it's we'll 12 345 I'M", "tab\tnew\x0bline\x0cfeed\x1cunit\x85next wide hard",
    "é ́alone café  two ẞΣ ΟΔΟΣ İstanbul", "a<|endoftext|>b <|startoftext|> < |endoftext| >",
    "\U0001f600 zero​width 你好 한글 한", "x" * 3000, "long " * 30000, "<|endoftext|>", "'S 's' ''ll ’s",
]


@pytest.mark.parametrize("block_ids, read_ids", [(1 << 16, 1 << 20), (64, 100)])
def test_ids_read_back_are_those_of_the_library(spark, tmp_path, block_ids, read_ids, monkeypatch):
    from tokenizers import Tokenizer

    rows = [(1000 - 7 * i, t, "p", "f") for i, t in enumerate(TEXTS * 3)]
    rows += [(None, "no id", "p", "f"), (5, "twice", "p", "f"), (5, "twice", "p", "f"), (5, None, "p", "f"), (-3, "first", None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    known = Tokenizer.from_file(bit_packing.default_vocabulary())
    ids = lambda text: known.encode(text or "", add_special_tokens=False).ids + [1]
    index = bit_packing.write_packed(docs, str(tmp_path / "ids"), block_ids=block_ids)
    crcs = [(d, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t, *_ in rows]
    got = bit_packing.read_packed(index, str(tmp_path / "ids"), read_ids).select("doc_id", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(crcs, key=repr)

    found = bit_packing.document_ids(docs, block_ids=block_ids).collect()
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=repr) == sorted(crcs, key=repr)


def test_remembered_words_are_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bit_packing, "CACHED_WORDS", 5)
    encoder = bit_packing.WordEncoder(bit_packing.default_vocabulary())
    for text in ("one two three", "three four five six", "a b c d e f g h"):
        ids, starts = encoder.encode(pa.array([text, None]))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert starts.tolist() == [0, len(ids), len(ids)]
        assert len(encoder.known) <= 8


def test_empty_table(spark):
    assert bit_packing.document_ids(spark.createDataFrame([], DOCS)).count() == 0


def test_memory_of_encoding_is_a_small_multiple_of_the_text():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(2000)]
    texts = pa.array([" ".join(rnd.choices(words, k=1000)) for _ in range(700)])
    encoder = bit_packing.WordEncoder(bit_packing.default_vocabulary())
    encoder.encode(texts[:1])
    tracemalloc.start()
    try:
        encoder.encode(texts)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 13 * texts.nbytes
