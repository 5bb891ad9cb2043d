"""Phrases of two to four words that belong together, mined as by Toivonen: guess from a sample, then prove.

A sample proposes phrases that may be frequent. A pass over all documents then counts every word, and every
longer phrase of which all proper parts were proposed: the proposed ones, and those just outside, their
negative border. The rule needs no list of the border: a phrase is counted where it stands, if its parts are known. When a
phrase outside turns out frequent, longer ones may be frequent that were not counted; the phrase
is added to what is known and another pass counts what that brings in, until nothing frequent is unknown. All
counts are exact then, and those of all frequent phrases are there.

What is known is a field of bits by hashes, of fixed size, so tasks hold as much at any size of the corpus. A
bit that is set by chance makes a pass count a phrase more, and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import chunks, materialize, text_bytes
from tallybrook.llm.words import mix

LONGEST = 4
FIELD_BITS = 26  # a field of 8 MB
SAMPLE_BYTES = 8 << 20
CHUNK_BYTES = 8 << 20
NO_LANG = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09]] = True
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def longer(shorter: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all but the last word and of that one; a language is the phrase of no word."""
    return mix(shorter * np.uint64(3) + word)


class Field:
    """A set of phrases as bits by their hashes; ``None`` holds every phrase."""

    def __init__(self, data: bytes | None):
        self.bits = None if data is None else np.frombuffer(data, np.uint8)

    @staticmethod
    def place(hashes: np.ndarray, bits: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - bits)).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(hashes), bool)
        at = self.place(hashes, (len(self.bits) * 8).bit_length() - 1)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


class Text:
    """The words of a chunk of texts in a row, and which of them stand in one piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, bounds = text_bytes(texts)
        raw = _LOWER[raw]
        breaks = _BREAK[raw]
        inside = ~(breaks | _SPACE[raw])
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = bounds[:-1][bounds[:-1] < len(raw)]
        begins[heads] = inside[heads]
        at = np.flatnonzero(begins)
        letters = np.cumsum(inside, dtype=np.int32)
        offsets = np.append(letters[at] - 1, letters[-1] if len(letters) else 0).astype(np.int32)
        data = pa.py_buffer(np.ascontiguousarray(raw[inside]))
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        words_of = np.diff(np.searchsorted(at, bounds))
        # Both parts rise, so their sum tells pieces apart.
        self.piece = np.cumsum(breaks, dtype=np.int32)[at] + np.repeat(np.arange(1, len(texts) + 1, dtype=np.int32), words_of)
        tongues = langs.dictionary_encode()
        self.langs, self.words = tongues.dictionary, coded.dictionary
        self.lang = np.repeat(tongues.indices.to_numpy(zero_copy_only=False), words_of)
        self.word = coded.indices.to_numpy(zero_copy_only=False)

    def terms(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different words of each language: language, word; and for each place which of them is there.

        A grid of languages and words while it is no larger than a few times the text; else only what occurs.
        """
        width, n = len(self.words), len(self.word)
        name = self.lang.astype(np.int64) * width + self.word
        if len(self.langs) * width <= 4 * n:
            keys = np.arange(len(self.langs) * width)
        else:
            keys, name = np.unique(name, return_inverse=True)
        return keys // width, keys % width, name


def _found(text: Text, first: np.ndarray, size: int, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of COUNTS for different phrases of ``size`` words that first stand at ``first``."""
    parts = [text.words.take(pa.array(text.word[first + j])) for j in range(size)]
    return _rows(text.langs.take(pa.array(text.lang[first])), pc.binary_join_element_wise(*parts, b" "), counts)


def _rows(langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs, phrases.cast(pa.string()), pa.array(counts)], schema=COUNTS)


def count_text(text: Text, known: Field, before: Field | None) -> Iterator[pa.RecordBatch]:
    """How often the chunk has each phrase whose proper parts are all ``known``.

    With ``before``, those whose proper parts were all known then are left out, as are words: they are
    counted already. Without, a phrase of no word counts all words of its language.
    """
    n = len(text.word)
    if not n:
        return
    own = np.fromiter(map(word_hash, text.words.to_pylist()), np.uint64, len(text.words))
    tongues = np.fromiter((word_hash(lang.encode()) for lang in text.langs.to_pylist()), np.uint64, len(text.langs))
    lang, word, name = text.terms()
    hashes = longer(tongues[lang], own[word])
    if before is None:
        langs, totals = np.unique(text.lang, return_counts=True)
        yield _rows(text.langs.take(pa.array(langs)), pa.array([""] * len(langs)), totals)
        counts = np.bincount(name, minlength=len(hashes))
        some = np.flatnonzero(counts)
        yield _rows(text.langs.take(pa.array(lang[some])), text.words.take(pa.array(word[some])), counts[some])
    good = known.holds(hashes)[name]
    old = np.zeros(n, bool) if before is None else before.holds(hashes)[name]
    for size in range(2, LONGEST + 1):
        if n < size:
            return
        whole = text.piece[: n - size + 1] == text.piece[size - 1 :]
        at = np.flatnonzero(whole & good[: n - size + 1] & good[1 : n - size + 2])
        if not len(at):
            return
        counted = old[at] & old[at + 1]
        keys = name[at] * len(own) + text.word[at + size - 1]
        if size < LONGEST:
            keys, first, index, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        else:  # nothing comes after
            at, keys = at[~counted], keys[~counted]
            counted = np.zeros(len(at), bool)
            keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
        new = ~counted[first]
        if new.any():
            yield _found(text, at[first[new]], size, counts[new])
        if size == LONGEST:
            return
        hashes = longer(hashes[keys // len(own)], own[keys % len(own)])
        name[at] = index
        good, old = np.zeros(n, bool), np.zeros(n, bool)
        good[at] = known.holds(hashes)[index]
        if before is not None:
            old[at] = counted & before.holds(hashes)[index]


def count_phrases(docs: DataFrame, known=None, before=None) -> DataFrame:
    """lang, phrase, n of ``docs`` (lang, text) by :func:`count_text`; ``known`` and ``before`` are broadcast fields."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Field(known.value if known else None)
        then = Field(before.value) if before else None
        for whole in batches:
            for batch in chunks(whole, "text", CHUNK_BYTES):
                yield from count_text(Text(batch.column("text"), batch.column("lang")), now, then)

    # A chunk has a phrase once already, and most phrases are in one chunk of a task alone: no more combining before the shuffle.
    dealt = docs.mapInArrow(scan, "lang string, phrase string, n long").repartition("lang", "phrase")
    return dealt.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes that :func:`count_text` has for them."""
    words = [p.encode().split(b" ") for p in phrases]
    size = np.fromiter(map(len, words), np.int64, len(words))
    hashes = np.fromiter((word_hash(lang.encode()) for lang in langs), np.uint64, len(langs))
    for k in range(int(size.max()) if len(size) else 0):
        some = np.flatnonzero(size > k)
        hashes[some] = longer(hashes[some], np.fromiter((word_hash(words[i][k]) for i in some), np.uint64, len(some)))
    return hashes


def unknown_bits(frequent: DataFrame, known, bits: int) -> np.ndarray | None:
    """The field of those phrases that have longer ones and are not ``known``; None where all are.

    Tasks make 64 bits at a time, combined by Spark: as many rows reach the driver as the field has words.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Field(known.value) if known else None
        for batch in batches:
            hashes = phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            if now:
                hashes = hashes[~now.holds(hashes)]
            at = np.unique(Field.place(hashes, bits))
            word, begin = np.unique(at >> 6, return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)), begin)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "value"])

    extensible = frequent.where((F.col("phrase") != "") & (words_of("phrase") < LONGEST)).select("lang", "phrase")
    found = extensible.mapInArrow(scan, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    if found.empty:
        return None
    field = np.zeros(1 << (bits - 6), np.int64)
    field[found["word"]] = found["value"]
    return field


def words_of(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def frequent_phrases(
    docs: DataFrame, least: int, sample_bytes: int = SAMPLE_BYTES, field_bits: int = FIELD_BITS, most_passes: int = 2 * LONGEST
) -> DataFrame:
    """lang, phrase, n of every phrase of one to four words that a language has ``least`` times, and of '', all its words.

    A sample of about ``sample_bytes`` of text proposes what occurs twice in it at least, or
    half as often as ``least`` would have it in such a part. After the first pass all words are
    counted, after each further one all phrases of a word more, so LONGEST passes always do.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    share = min(1.0, sample_bytes / max(1, total))
    if share < 1:
        proposed = count_phrases(texts.where(F.rand(17) < share)).where(F.col("n") >= max(2, int(least * share / 2)))
    else:
        proposed = count_phrases(texts).where(F.col("n") >= least)
    field = unknown_bits(materialize(proposed, "proposed"), None, field_bits)
    field = np.zeros(1 << (field_bits - 6), np.int64) if field is None else field
    known, before, found = context.broadcast(field.tobytes()), None, []
    for _ in range(most_passes):
        counted = count_phrases(texts, known, before).where((F.col("n") >= least) | (F.col("phrase") == ""))
        found.append(materialize(counted, "phrases"))
        more = unknown_bits(found[-1], known, field_bits)
        if before:
            before.destroy()
        if more is None:
            known.destroy()
            return reduce(DataFrame.unionAll, found)
        field = field | more
        before, known = known, context.broadcast(field.tobytes())
    raise RuntimeError(f"not closed after {most_passes} passes")


def collocations(
    docs: DataFrame, least: int = 30, scale: int = 2_000_000, cover_num: int = 80, cover_den: int = 100, top: int = 2000, **mining
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Of ``docs`` only lang and text are looked at. A phrase of two to four words that occurs
    a >= ``least`` times is scored by its worst cut into two: floor(scale * a / (l + r)), l and r being how often the parts
    occur; the shortest first part wins a tie. It goes if a longer such phrase holds it and occurs at least
    ``cover_num / cover_den`` as often. The ``top`` by score, a and phrase (bytes) stay. n is the language's number of words.
    A null language is 'und', a null text an empty one; repeated rows count again. An empty table gives no rows.
    """
    counts = materialize(frequent_phrases(docs, least, **mining), "frequent")
    words = counts.where("phrase = ''").select("lang", "n")
    terms = counts.where("phrase <> ''")
    candidates = terms.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words")).where(F.size("words") > 1)
    size = F.size("words")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, size - F.col("cut")).alias("right")
    )
    lefts = terms.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = terms.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.call_function("div", wide("a") * F.lit(scale).cast("decimal(18,0)"), wide("l") + wide("r"))
    worst = (
        cuts.join(lefts, ["lang", "left"])
        .join(rights, ["lang", "right"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst"))
    )
    starts = F.sequence(F.lit(1), F.lit(LONGEST - 1))
    inner = (
        candidates.where(size > 2)
        .select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("length"))
        .select("*", F.explode(F.filter(starts, lambda s: s + F.col("length") - 1 <= size)).alias("start"))
        .select("lang", "a", part(F.col("start"), F.col("length")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    covered = F.coalesce(wide("around") * cover_den >= wide("a") * cover_num, F.lit(False))
    left = worst.join(inner, ["lang", "phrase"], "left").where(~covered).select("lang", "phrase", "a", "worst.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language may have most phrases: the best of each of its parts first, then of what is left.
    parted = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(words), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
