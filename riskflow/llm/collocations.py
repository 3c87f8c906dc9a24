"""Phrase collocations by multikey quicksort of suffix pointers.

A suffix starts at each word of a piece of text and is read for up to ``MAX_WORDS`` words. Tasks cut their texts
into chunks, sort the suffixes of a chunk, count equal ones once and deal them out by their leading words. So all
suffixes that share their leading words meet in one bucket, where a multikey three-way quicksort parts the
pointers word by word: the size of an equal part is the count of the phrase that all its suffixes start with, and
parts below ``MIN_COUNT`` are abandoned.

Words are counted first. A suffix is dealt by its words up to the first one that is not hot, that is, occurs no
more often than a bucket has room for; equal suffixes of hot words alone are one row per chunk. So no bucket grows
with a frequent word, phrase or passage. Phrases that consist of hot words only may lie in several buckets; their
parts are summed, as everything else is, by one aggregate. Hot words are few by their definition: their counts
add up to no more than all words. If there are more than ``FANOUT`` buckets, suffixes are dealt in several rounds,
and each round counts equal ones together again.

Scores and the comparison with longer phrases are joins of frequent phrases, in exact decimal arithmetic.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import bounded_batches, text_rows
from riskflow.session import materialize

MAX_WORDS = 4
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
SCORE_UNIT = 2_000_000
CHUNK_WORDS = 1 << 20  # suffixes that a task sorts at a time
BUCKET_WORDS = 1 << 20  # occurrences of a word above which it is hot; grows so that hot words stay below MAX_HOT
MAX_HOT = 1 << 20
FANOUT = 1024
MAX_PARTITIONS = 20_000  # beyond that a task reads several buckets, one after the other
COUNTER_WORDS = 1 << 18  # distinct words that a task holds before it hands them on
UNKNOWN = "und"
GAP = b"."  # a separator between pieces, so never part of a word
SHARDS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    string.ascii_uppercase.encode() + _ENDS + b"\t", string.ascii_lowercase.encode() + GAP * len(_ENDS) + b" "
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in order, with a ``GAP`` between pieces."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).replace(GAP, b" . ").split()


def _languages(batch: pa.RecordBatch) -> list[str]:
    return [UNKNOWN if lang is None else lang for lang in batch.column("lang").to_pylist()]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n), partial counts; a task holds a bounded number of distinct words."""
    found: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        langs = [lang for lang, counts in found.items() for _ in counts]
        words = [word.decode("utf-8", "surrogatepass") for counts in found.values() for word in counts]
        counted = [n for counts in found.values() for n in counts.values()]
        found.clear()
        columns = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counted, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(_languages(batch), batch.column("text").to_pylist()):
            found[lang].update(words_of(text))
            found[lang].pop(GAP, None)
            if sum(map(len, found.values())) > COUNTER_WORDS:
                yield rows()
    yield rows()


class Suffixes:
    """Distinct suffixes with counts: ``codes[d]`` numbers the d-th word of each, 0 where it has ended."""

    def __init__(self, words: list[bytes], codes: np.ndarray, counts: np.ndarray):
        self.words, self.codes, self.counts = words, codes, counts

    @classmethod
    def of(cls, words: list[bytes], codes: np.ndarray, counts: np.ndarray) -> Suffixes:
        """Sorted, with equal suffixes counted together. ``words[0]`` stands for no word."""
        order = np.lexsort(codes[::-1])
        codes, counts = codes[:, order], counts[order]
        first = np.r_[True, (codes[:, 1:] != codes[:, :-1]).any(axis=0)][: len(counts)]
        starts = np.flatnonzero(first)
        return cls(words, codes[:, starts], np.add.reduceat(counts, starts) if len(starts) else counts)

    def pack(self, rows: np.ndarray) -> tuple[bytes, bytes]:
        """The given rows with the words that they use, compressed."""
        codes = self.codes[:, rows]
        used = np.unique(codes)
        used = used if len(used) and used[0] == 0 else np.r_[0, used]
        local = np.searchsorted(used, codes).astype("<i4")
        local[0] = np.diff(local[0], prepend=0)
        planes = [np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4).T).tobytes() for part in local]
        packed = zstandard.compress(b"".join(planes) + self.counts[rows].astype("<i8").tobytes(), 1)
        return b"\n".join([self.words[i] for i in used[1:]]), packed

    @staticmethod
    def unpack(words: bytes, packed: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        data = np.frombuffer(zstandard.decompress(packed), np.uint8)
        n = len(data) // (4 * MAX_WORDS + 8)
        planes = data[: 4 * MAX_WORDS * n].reshape(MAX_WORDS, 4, n)
        codes = planes.transpose(0, 2, 1).copy().view("<i4")[..., 0]
        codes[0] = np.cumsum(codes[0])
        return words.split(b"\n"), codes, data[4 * MAX_WORDS * n :].view("<i8")


def _windows(codes: np.ndarray) -> np.ndarray:
    """The suffixes of at least two words in a row of numbered words; 0 stands between pieces."""
    padded = np.r_[codes, np.zeros(MAX_WORDS, codes.dtype)]
    windows = np.stack([padded[d : d + len(codes)] for d in range(MAX_WORDS)])
    for d in range(1, MAX_WORDS):
        windows[d][windows[d - 1] == 0] = 0
    return windows[:, (windows[0] != 0) & (windows[1] != 0)]


def _routes(lang: str, suffixes: Suffixes, hot: set[bytes], buckets: int) -> np.ndarray:
    """The bucket of each suffix, by its words up to the first that is not hot."""
    hashes = np.array([0, *(xxhash.xxh64_intdigest(w) for w in suffixes.words[1:])], np.uint64)
    is_hot = np.array([False, *(w in hot for w in suffixes.words[1:])])
    route = np.full(suffixes.codes.shape[1], xxhash.xxh64_intdigest(lang), np.uint64)
    further = np.ones(len(route), bool)
    for column in suffixes.codes:
        mixed = (route ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
        route = np.where(further, mixed ^ (mixed >> np.uint64(29)), route)
        further &= is_hot[column]
    return (route % np.uint64(buckets)).astype(np.int64)


class _Chunk:
    """Suffixes of one language until there are enough to sort and deal."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        self.numbers[GAP] = 0
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, codes: np.ndarray, counts: np.ndarray | None = None) -> int:
        """How many suffixes have come in."""
        self.codes.append(codes)
        self.counts.append(np.ones(codes.shape[1], np.int64) if counts is None else counts)
        self.size += codes.shape[1]
        return codes.shape[1]

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))

    def sorted(self) -> Suffixes:
        words = [b"", *[w for w in self.numbers if w != GAP]]
        return Suffixes.of(words, np.concatenate(self.codes, axis=1), np.concatenate(self.counts))


def _dealt(chunks: dict[str, _Chunk], hot: dict[str, set[bytes]], buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    """(bucket, lang, words, suffixes): a row per language and run of ``width`` buckets; empties ``chunks``."""
    names = ["bucket", "lang", "words", "suffixes"]
    for lang, chunk in chunks.items():
        if not chunk.size:
            continue
        suffixes = chunk.sorted()
        group = _routes(lang, suffixes, hot.get(lang, set()), buckets) // width
        order = np.argsort(group, kind="stable")
        ends = np.flatnonzero(np.diff(group[order], append=-1)) + 1
        for start, end in zip(np.r_[0, ends[:-1]], ends):
            words, packed = suffixes.pack(order[start:end])
            row = [[int(group[order[start]])], [lang], [words], [packed]]
            types = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)
    chunks.clear()


PACKED = "bucket bigint, lang string, words binary, suffixes binary"


def _deal_texts(docs: DataFrame, hot: dict[str, set[bytes]], buckets: int, width: int, chunk_words: int) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, _Chunk] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(_languages(batch), batch.column("text").to_pylist()):
                chunk = chunks.setdefault(lang, _Chunk())
                held += chunk.add(_windows(chunk.number(words_of(text))))
                if held >= chunk_words:
                    yield from _dealt(chunks, hot, buckets, width)
                    held = 0
        yield from _dealt(chunks, hot, buckets, width)

    return docs.mapInArrow(deal, PACKED)


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, str], bytes, bytes]]:
    for batch in batches:
        for bucket, lang, words, packed in zip(*[batch.column(n).to_pylist() for n in batch.schema.names]):
            yield (bucket, lang), words, packed


def _add(chunk: _Chunk, words: bytes, packed: bytes) -> int:
    own, codes, counts = Suffixes.unpack(words, packed)
    return chunk.add(np.r_[0, chunk.number(own)].astype(np.int32)[codes], counts)


def _deal_again(dealt: DataFrame, hot: dict[str, set[bytes]], buckets: int, width: int, chunk_words: int) -> DataFrame:
    """Runs of buckets that have met, dealt to shorter runs."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, _Chunk] = {}
        last, held = None, 0
        for (bucket, lang), words, packed in _received(batches):
            if bucket != last or held >= chunk_words:
                yield from _dealt(chunks, hot, buckets, width)
                held = 0
            last = bucket
            held += _add(chunks.setdefault(lang, _Chunk()), words, packed)
        yield from _dealt(chunks, hot, buckets, width)

    return dealt.mapInArrow(deal, PACKED)


def quicksort_phrases(suffixes: Suffixes, hot: set[bytes], least: int) -> Iterator[tuple[list[bytes], int]]:
    """Phrases of two or more words with their counts, by multikey three-way quicksort.

    Pointers are parted by the word at a depth into less, equal and greater; the equal part goes on at the next
    depth and its summed counts are the phrase's. Parts below ``least`` are abandoned, unless all their words so
    far are hot: such a phrase may go on in other buckets.
    """
    codes, counts, words = suffixes.codes, suffixes.counts, suffixes.words
    is_hot = np.array([w in hot for w in words])
    waiting = [(np.arange(codes.shape[1]), 0, True)] if codes.shape[1] else []
    while waiting:
        pointers, depth, partial = waiting.pop()
        column = codes[depth][pointers]
        sample = np.sort(column[:: max(1, len(column) // 9)])
        pivot = sample[len(sample) // 2]
        equal = column == pivot
        for part in (pointers[column < pivot], pointers[column > pivot]):
            if len(part) and (counts[part].sum() >= least or (partial and is_hot[codes[depth][part]].any())):
                waiting.append((part, depth, partial))
        if pivot == 0:
            continue  # the phrases that end here
        same, inside = pointers[equal], partial and bool(is_hot[pivot])
        total = int(counts[same].sum())
        if total < least and not inside:
            continue
        if depth:
            yield [words[c] for c in codes[: depth + 1, same[0]]], total
        if depth + 1 < MAX_WORDS:
            waiting.append((same, depth + 1, inside))


def _met(texts: DataFrame, hot: dict[str, set[bytes]], buckets: int, chunk_words: int, fanout: int) -> DataFrame:
    """All suffixes, those of a bucket together in one partition and one after the other.

    A task deals to at most about ``fanout`` runs of buckets at a time. A run that is dealt again need not meet as a
    whole, so it is spread over many tasks.
    """
    rounds = 1
    while fanout**rounds < buckets:
        rounds += 1
    step = max(2, ceil(buckets ** (1 / rounds)))
    width = step ** (rounds - 1)
    dealt = _deal_texts(texts, hot, buckets, width, chunk_words)
    while width > 1:
        width //= step
        spread = dealt.repartition("bucket", F.pmod(F.xxhash64("suffixes"), F.lit(SHARDS)))
        dealt = materialize(_deal_again(spread.sortWithinPartitions("bucket"), hot, buckets, width, chunk_words), "dealt")
    return dealt.repartition(min(buckets, MAX_PARTITIONS), "bucket").sortWithinPartitions("bucket", "lang")


def _mine(dealt: DataFrame, hot: dict[str, set[bytes]], least: int) -> DataFrame:
    """(lang, phrase, n) of the buckets that have met; phrases of hot words may come in parts."""

    def rows(lang: str, chunk: _Chunk) -> Iterator[pa.RecordBatch]:
        found = list(quicksort_phrases(chunk.sorted(), hot.get(lang, set()), least))
        phrases = [b" ".join(words).decode("utf-8", "surrogatepass") for words, _ in found]
        columns = [pa.array([lang] * len(found), pa.string()), pa.array(phrases, pa.string())]
        columns.append(pa.array([n for _, n in found], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n"])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, last = _Chunk(), None
        for key, words, packed in _received(batches):
            if key != last and chunk.size:
                yield from rows(last[1], chunk)
                chunk = _Chunk()
            last = key
            _add(chunk, words, packed)
        if chunk.size:
            yield from rows(last[1], chunk)

    return dealt.mapInArrow(mine, "lang string, phrase string, n bigint")


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    bucket_words: int = BUCKET_WORDS,
    chunk_words: int = CHUNK_WORDS,
    fanout: int = FANOUT,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of one to ``MAX_WORDS`` words with f >= ``min_count``, and (lang, n) of all words."""
    bounded_batches(docs.sparkSession)
    texts = text_rows(docs, text_col, lang_col).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    counted = texts.mapInArrow(_word_counts, "lang string, word string, n bigint")
    words = materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    room = max(bucket_words, total // MAX_HOT)
    hot: dict[str, set[bytes]] = defaultdict(set)
    for r in words.filter(F.col("f") > room).select("lang", "word").collect():  # at most MAX_HOT rows
        hot[r.lang].add(r.word.encode("utf-8", "surrogatepass"))
    hot = dict(hot)
    buckets = max(1, ceil(2 * total / room))
    met = _met(texts, hot, buckets, chunk_words, fanout)
    phrases = _mine(met, hot, min_count).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    both = phrases.unionByName(words.withColumnRenamed("word", "phrase")).filter(F.col("f") >= min_count)
    return materialize(both, "phrases"), totals


def _decimal(number: Column) -> Column:
    return number.cast("decimal(20,0)")


def _scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, score) of phrases of two or more words, by their worst cut."""
    split = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice("words", F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice("words", k + 1, F.size("words")), " ").alias("right"),
        ),
    )
    cut = (
        phrases.select("lang", "phrase", split.alias("words"), F.col("f").alias("a"))
        .filter(F.size("words") > 1)
        .select("lang", "phrase", "words", "a", F.explode(cuts).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.*")
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = phrases.select(F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(name))
        cut = cut.join(part, ["lang", side])
    unit = _decimal(F.lit(SCORE_UNIT)) * _decimal(F.col("a"))
    return (
        cut.withColumn("unit", unit)
        .withColumn("score", F.expr("unit div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
        .select("lang", "phrase", "words", "a", "worst.*")
    )


def _uncovered(scored: DataFrame, percent: int) -> DataFrame:
    """Candidates without a longer one around them that is nearly as frequent."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("words") - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size("words") - n + 1),
                lambda at: F.array_join(F.slice("words", at, n), " "),
            ),
        )
    )
    around = (
        scored.filter(F.size("words") > 2)
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longest"))
    )
    covered = _decimal(F.col("longest")) * 100 >= _decimal(F.col("a")) * percent
    return scored.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    percent: int = COVERED_PERCENT,
    top: int = TOP,
    **sizes: int,
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased in A-Z only; phrases of 2 to 4 words stay within pieces that end at ``.,;:!?`` or a line
    end. ``a``, ``l`` and ``r`` count the phrase and the two parts of its worst cut, ``n`` all words of the
    language. Equal scores go by ``a``, then by the bytes of the phrase. A null language is ``und``; null and empty
    texts hold no word; repeated rows count each time. Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    phrases, totals = frequent_phrases(docs, text_col, lang_col, min_count, **sizes)
    left = _uncovered(materialize(_scored(phrases), "scored"), percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(SHARDS))
    # Shards first, so that no task ranks all phrases of a language.
    best = left.withColumn("shard", shard).withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "shard").orderBy(*order))
    )
    ranked = best.filter(F.col("at") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    )
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
