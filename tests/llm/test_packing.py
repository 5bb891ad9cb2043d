import zlib

import numpy as np
import pytest

from tallybrook.llm import packing, tokens

DOCS = "doc_id long, text string, sequence_id string"


def whole(spark):
    # The special token's string is its id by the vocabulary's own settings.
    words = "alpha beta gamma <|endoftext|> Ünïcode 12 345\n"
    rows = [(i, words * (1 + 37 * i % 300), "x") for i in range(40)]
    rows += [(3, "", "x"), (3, "", "x"), (4, None, None), (None, "no id", "x"), (50, "word " * 20000, "x")]
    return spark.createDataFrame(rows, DOCS)


def test_pieces_hold_every_token_once(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    encoder = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = whole(spark)
    assert 50256 in encoder.encode(docs.first().text, add_special_tokens=False).ids
    expected = []
    for doc_id, text, _ in docs.collect():
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = packing.token_pieces(docs).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("rows_per_group", [16384, 20])
def test_sequences_have_no_holes(spark, rows_per_group):
    rows = packing.pack(packing.token_pieces(whole(spark)), rows_per_group=rows_per_group).toPandas()
    assert len(rows) == packing.token_pieces(whole(spark)).count()
    rows = rows.sort_values(["sequence_id", "offset"])
    own = rows.groupby("sequence_id")["length"]
    assert ((own.cumsum() - rows["length"]) == rows["offset"]).all()
    assert own.sum().max() <= 1024
    best = packing.lower_bound(rows["length"].to_numpy(), 1024)
    assert best <= rows["sequence_id"].nunique() <= best + (1 if rows_per_group > 100 else 3)


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(spark.createDataFrame([], DOCS))).count() == 0


def test_lower_bound_never_exceeds_the_best_packing():
    rng = np.random.default_rng(0)
    for _ in range(100):
        bins = rng.integers(1, 6)
        sizes = np.concatenate([np.diff(np.sort(np.append(rng.integers(0, 33, rng.integers(0, 5)), [0, 32]))) for _ in range(bins)])
        sizes = sizes[sizes > 0]
        assert packing.lower_bound(sizes, 32) == bins  # full bins: the sum alone is tight
        _, _, used = packing.best_fit(sizes, 32)
        assert used >= bins
    assert packing.lower_bound(np.array([20, 20, 20]), 32) == 3


def test_ids_are_those_of_the_vocabulary():
    path = tokens.default_vocabulary()
    assert len(tokens.encode(None, path)) == 0 and len(tokens.encode("", path)) == 0
    assert tokens.encoder(path).decode(tokens.encode("naïve text", path).tolist()) == "naïve text"
