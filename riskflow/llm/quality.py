"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets are counted, one
from all documents, one from trusted documents; a document's score is the mean over its n-grams of the
logarithm of their ratio, so length does not count. It is kept if its base counts pass and the score reaches
a fixed threshold.

Everything is built of Spark's functions. Texts are read once: base counts and the bucket of each word are
stored, and counting and scoring start from these. Counts shrink to one row per bucket before the shuffle, and
the table of ratios, whose length is the number of buckets, is all that the driver sees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import once, text_rows, with_value
from riskflow.session import materialize

BUCKETS = 8192  # for words, and as many again for pairs
THRESHOLD = -0.12
SMOOTHING = 5.0
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_BLANKS = r"[ \t-\r]+"
_WORD_CHAR = r"[^ \t-\r]"
_SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r."""
    return F.array_remove(F.split(text, _BLANKS), "")


def word_windows(words: Column, size: int = REPEAT_WORDS) -> Column:
    """Every run of ``size`` words as one string; none for shorter texts."""
    return F.when(
        F.size(words) >= size,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(size)))
        ),
    ).otherwise(F.array().cast("array<string>"))


def covered_by_repeats(windows: Column, size: int = REPEAT_WORDS) -> Column:
    """How many words lie in windows that occur twice or more."""

    def repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["w"] == x["w"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def widen(seen: Column, start: Column) -> Column:
        fresh = start + size - F.greatest(start, seen["end"])
        return F.struct((start + size).alias("end"), (seen["total"] + fresh).alias("total"))

    ordered = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    covered = F.aggregate(with_value(ordered, repeated), zero, widen, lambda seen: seen["total"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return with_value(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD_CHAR)),
        lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
    )


def bucket_type(buckets: int) -> str:
    return "smallint" if buckets <= 1 << 15 else "int"


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, the four base counts, base_failed, and the hash bucket of each word in order."""
    source = text_rows(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    worded = source.select("doc_id", "text", once(words_of(F.col("text"))).alias("words"))
    windowed = worded.select("*", once(word_windows(F.col("words"))).alias("windows"))
    counted = windowed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        covered_by_repeats(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast(bucket_type(buckets))).alias("word_buckets"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _grams(word_buckets: Column, buckets: int) -> Column:
    """Buckets of the words, and behind them those of the pairs of neighbours."""
    pairs = F.zip_with(
        F.slice(word_buckets, F.lit(1), F.greatest(F.size(word_buckets) - 1, F.lit(0))),
        F.slice(word_buckets, F.lit(2), F.greatest(F.size(word_buckets) - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int") + buckets,
    )
    return F.concat(word_buckets.cast("array<int>"), pairs)


def log_ratios(counted: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """ln(trusted share / raw share) of each bucket, over all documents of the table.

    Trusted are documents that ``labels`` calls good and never bad. Without any of them, those that pass
    the base rules are.
    """
    trusted = materialize(
        text_rows(labels, "doc_id", "quality")
        .filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("labelled"),
        "trusted",
    )
    flagged = counted.select("doc_id", "word_buckets", "base_failed")
    if trusted.isEmpty():
        flagged = flagged.withColumn("good", ~F.col("base_failed"))
    else:
        # One plan at every size: what is shuffled grows with the table, not in steps.
        flagged = flagged.join(trusted.hint("merge"), F.col("doc_id") == F.col("labelled"), "left").withColumn(
            "good", F.col("labelled").isNotNull()
        )
    grams = flagged.select("good", F.explode(_grams(F.col("word_buckets"), buckets)).alias("bucket"))
    rows = (
        grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good")).collect()
    )
    raw, good = [0.0] * 2 * buckets, [0.0] * 2 * buckets
    for r in rows:
        raw[r.bucket], good[r.bucket] = float(r.n), float(r.good)
    ratios = []
    for half in (slice(0, buckets), slice(buckets, 2 * buckets)):  # a multinomial of words and one of pairs
        share = sum(good[half]) / max(sum(raw[half]), 1.0)
        # Both counts get as many n-grams as if there were no difference, so rare buckets tell little.
        ratios += [
            math.log((g + SMOOTHING) / (r * share + SMOOTHING)) for g, r in zip(good[half], raw[half])
        ]
    return ratios


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    A null text has no words, fails the base rules and has a null score, as any text without words. Repeated
    rows are counted and judged one by one. Other columns are ignored, whatever their names. An empty
    table gives an empty result.
    """
    counted = materialize(base_counts(docs, id_col, text_col, buckets), "counted")
    # A text constant of known length, which the optimizer turns into one array.
    table = F.split(F.lit(",".join(map(repr, log_ratios(counted, labels, buckets)))), ",").cast("array<double>")
    total = with_value(
        _grams(F.col("word_buckets"), buckets),
        lambda grams: F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get(table, b)) / F.size(grams),
    )
    score = F.when(F.col("n_words") > 0, total)
    return counted.withColumn("score", score).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))).alias("kept"),
        "score",
    )
