"""Line deduplication: lines that many documents share stay in one of them.

Lines are normalised, hashed to 128 bits and stored per document, in their order. Hashes are exploded once per
document and counted with partial sums; those in enough documents keep the largest id that holds them. Hashes
that meet such a row from another document give the positions to drop, and the document is put together from
the positions that are left. Text is read twice and shuffled once; all else moves hashes. A line of a third of
all documents is summed before it is shuffled, and its join has one row per hash on the other side, so Spark can
split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import fold_ascii, once, text_rows, with_value
from riskflow.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """For each line the hash (k1, k2) of its key, null for a key of fewer code points than ``min_chars``."""

    def key(line: Column) -> Column:
        stripped = F.btrim(line, F.lit(BLANKS))
        hashed = F.struct(F.xxhash64(F.lit(0), stripped).alias("k1"), F.xxhash64(F.lit(-1), stripped).alias("k2"))
        return F.when(F.char_length(stripped) >= min_chars, hashed)

    return F.transform(F.split(fold_ascii(text), "\n"), key)


def _distinct(keys: Column) -> Column:
    """The keys without nulls, each once; ``array_distinct`` compares every two structs, this sorts them."""

    def first_of_each(ordered: Column) -> Column:
        return F.filter(ordered, lambda key, i: (i == 0) | (key != F.get(ordered, i - 1)))

    return with_value(F.sort_array(F.filter(keys, lambda key: key.isNotNull())), first_of_each)


def _dropped(texts: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(id, print, dropped): the positions that a document with this id and text loses, if there are any."""
    keyed = materialize(texts.select("id", "print", line_keys(F.col("text"), min_chars).alias("keys")), "line-keys")
    each = keyed.select("id", F.explode(_distinct(F.col("keys"))).alias("key"))
    shared = materialize(
        each.groupBy("key.k1", "key.k2")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keep"))
        .filter(F.col("docs") >= min_docs)
        .drop("docs"),
        "shared-lines",
    )
    lines = keyed.select("id", "print", F.posexplode("keys").alias("pos", "key")).filter("key IS NOT NULL")
    lost = lines.select("id", "print", "pos", "key.k1", "key.k2").join(shared, ["k1", "k2"]).filter("NOT id <=> keep")
    # A set, because rows that repeat id and text lose the same positions.
    return lost.groupBy("id", "print").agg(F.collect_set("pos").alias("dropped"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    whole = text_rows(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return whole.withColumn("print", F.xxhash64("text"))


def deduplicate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_text.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
    that at least ``min_docs`` documents hold lose all their lines but those of the largest id that holds them.
    A document is a row, so repeated rows count one by one; rows that share the largest id all keep the line, and
    a null id is smaller than all others. Null and empty texts have one empty line. Lines without a word or with a
    short key always stay. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    texts = _texts(docs, id_col, text_col)
    lost = materialize(_dropped(texts, min_chars, min_docs), "lost-lines").select(
        F.col("id").alias("lost_id"), F.col("print").alias("lost_print"), "dropped"
    )
    same = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("print") == F.col("lost_print"))
    joined = texts.join(lost, same, "left").select("id", "text", "dropped")
    split = joined.select("id", "text", "dropped", once(F.split("text", "\n")).alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return split.select(
        F.col("id").alias("doc_id"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )
