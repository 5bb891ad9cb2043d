import numpy as np
import pytest

from tallybrook.llm import token_files, tokens


@pytest.mark.parametrize("block_bytes", [4 << 20, 64, 2])
def test_counts_match_the_encoder(spark, block_bytes):
    rows = [(i, "some words here " * (i % 5), "x") for i in range(30)] + [(7, None, "y"), (None, "no id", "y"), (7, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string").repartition(3)
    got = token_files.document_token_counts(docs, block_bytes=block_bytes)
    path = tokens.default_vocabulary()
    expected = [(i, len(tokens.encode(t, path))) for i, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert token_files.document_token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_open_end_and_odd_bytes(spark, tmp_path):
    end = token_files.END_ID
    ids = np.array([5, 6, end, end, 7, 8, 9], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes() + b"\1")  # half an id at the end
    (tmp_path / "b.bin").write_bytes(np.array([1, end], "<u2").tobytes())
    (tmp_path / "c.bin").write_bytes(b"")
    for block in (2, 6, 1024):
        got = token_files.count_tokens(spark, str(tmp_path), block_bytes=block)
        rows = sorted((r.file, r.ordinal, r.start, r.n_tokens, r.ended) for r in got.collect())
        assert rows == [
            ("a.bin", 0, 0, 2, True),
            ("a.bin", 1, 3, 0, True),
            ("a.bin", 2, 4, 3, False),
            ("b.bin", 0, 0, 1, True),
        ]
    with pytest.raises(ValueError):
        token_files.count_tokens(spark, str(tmp_path), block_bytes=3)
