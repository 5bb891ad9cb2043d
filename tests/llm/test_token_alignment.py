import hashlib
from collections import Counter

import numpy as np
import pytest

from tallybrook.llm import token_alignment, tokens

DOCS = "doc_id long, text string, block string, n_best string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(rows):
    """Every link by comparing byte ranges, with the libraries' own decoders."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = token_bytes()
    found, count = [], Counter()
    for doc_id, text, *_ in rows:
        a = a_side.encode(f" {text or ''}", add_special_tokens=False).ids if text else []
        b = b_side.encode(text or "")
        of_a = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        of_b = [b_side.id_to_piece(i) for i in b]
        of_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in of_b]
        raw = f" {text}".encode()
        if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
            found.append((doc_id, 0, 0, [], None))
            continue
        ranges = [np.cumsum([0, *map(len, side)]) for side in (of_a, of_b)]
        links = [
            (a[i], b[j]) for i in range(len(a)) for j in range(len(b))
            if ranges[0][i] < ranges[1][j + 1] and ranges[1][j] < ranges[0][i + 1]
        ]
        count.update(links)
        groups, left, right = [], [], []
        ends = sorted({*ranges[0][1:].tolist()} & {*ranges[1][1:].tolist()})
        for low, high in zip([0, *ends], ends):
            left = [str(a[i]) for i in range(len(a)) if low < ranges[0][i + 1] <= high]
            right = [str(b[j]) for j in range(len(b)) if low < ranges[1][j + 1] <= high]
            groups.append(f"{','.join(left)}|{','.join(right)}")
        found.append((doc_id, len(a), len(b), links, groups))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (
            doc_id, n_a, n_b, len(groups or ()), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, links, groups in found
    ]


def token_bytes():
    """How a byte-level vocabulary writes bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


TEXTS = [
    "The quick brown fox, it's 1234 over the lazy dog.", "", None, "   indented\n\n\tlines  \n", "<s> and </s>, <unk>, <0x41> <|endoftext|>",
    "naïve Übergröße à l'école niño", "\U0001f600\U0001f9d1‍\U0001f680 你好世界 한국어 עברית", "already ▁ marked", "▁", "nul\0byte \x7f\x80",
    "internationalization unbelievably counterrevolutionaries", "x" * 200, "aaa aaaa aaaaa " * 9, " leading space", "é é",
]


@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_links_are_those_of_the_byte_ranges(spark, block_bytes):
    rows = [(i % 13, t, "x", "y") for i, t in enumerate(TEXTS + TEXTS[:9])] + [(None, "no id at all", None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = token_alignment.alignments(docs, block_bytes=block_bytes)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_force(rows), key=repr)


def test_words_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy(F_length()).limit(60)
    rows = [tuple(r) for r in docs.collect()]
    got = token_alignment.alignments(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=20_000)
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows))


def F_length():
    from pyspark.sql import functions as F

    return F.length("text")


def test_long_text_and_wide_places(spark, monkeypatch):
    """A long text is a block of its own; many different pairs need four bytes a place."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæœ' -0123456789"))
    text = "".join(rng.choice(letters, 900_000).tolist())
    docs = spark.createDataFrame([(1, text), (2, "abc")], "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in token_alignment.alignments(docs, block_bytes=1000).collect()}
    both = token_alignment.vocabularies(tokens.default_vocabulary(), token_alignment.default_pieces())
    a, b = both.encode(text)
    ends = np.union1d(np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b]))
    assert (rows[1].n_a, rows[1].n_b, rows[1].n_links) == (len(a), len(b), len(ends))
    assert rows[1].n_best <= rows[1].n_links <= rows[1].count_sum


def test_empty_tables(spark):
    assert token_alignment.alignments(spark.createDataFrame([], DOCS)).count() == 0
    nothing = token_alignment.alignments(spark.createDataFrame([(1, None, None, None), (2, "", None, None)], DOCS))
    assert sorted(map(tuple, nothing.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
