"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. The distinct blocks of the corpus are sorted and
numbered, so a number names one block and a block has one number. Then neighbouring names are paired, the
distinct pairs are sorted and numbered in turn, and so on: the names of a document halve with each round
until one is left, which two documents share exactly if their texts are equal.

Text is shuffled once. Blocks meet under a key of 128 hash bits, and the smallest and the largest block
under each key are compared: only if they are equal for every key does a key stand for one block. Else all
blocks get other keys and are compared again, so no result ever rests on a hash alone. Everything after that
moves integers. Counting and naming are partial aggregates, and every join has a stored lookup with one row
per key on its right side, so Spark can split the rows of a text that a third of the corpus repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import fold_ascii, once, one_of_each, packed_rows, text_rows, with_value
from riskflow.session import materialize

BLOCK_BYTES = 4096
NO_NAME = -1  # stands for the missing right half of an odd last block


def hash_keys() -> Iterator[Callable[[Column], Column]]:
    """Ways to make a 128-bit key from a block, each with another seed."""
    for seed in count():
        yield partial(_key, seed)


def _key(seed: int, block: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), block).alias("k1"), F.xxhash64(F.lit(~seed), block).alias("k2"))


def _blocks(text: Column, block_bytes: int) -> Column:
    last = F.greatest(F.floor((F.octet_length(text) - 1) / block_bytes), F.lit(0)).cast("int")
    return with_value(
        text.cast("binary"),
        lambda data: F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)),
        ),
    )


def _numbered(keys: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys with an integer name each, in sorted order within their partition."""
    ordered = keys.sortWithinPartitions(*columns)
    return materialize(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def _first_names(texts: DataFrame, block_bytes: int, keys) -> tuple[DataFrame, DataFrame]:
    """The documents with row numbers, and (row, n, pos, name) for each of their n blocks."""
    for key_of in keys:
        documents = materialize(
            texts.select(
                F.monotonically_increasing_id().alias("row"),
                "doc_id",
                F.sha2("text", 256).alias("text_sha256"),
                F.transform(_blocks(F.col("text"), block_bytes), lambda block: key_of(block)).alias("keys"),
            ),
            "documents",
        )
        found = (
            texts.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
            .select(key_of(F.col("block")).alias("key"), "block")
            .groupBy("key.k1", "key.k2")
            .agg(F.min("block").alias("low"), F.max("block").alias("high"))
            .select("k1", "k2", (F.col("low") != F.col("high")).alias("clash"))
        )
        names = _numbered(found, "k1", "k2")
        if names.filter("clash").isEmpty():
            break
    items = documents.select(
        "row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key")
    ).select("row", "n", "pos", "key.k1", "key.k2")
    named = items.join(names.drop("clash"), ["k1", "k2"]).select("row", "n", "pos", "name")
    return documents.select("row", "doc_id", "text_sha256"), materialize(named, "named")


def _pair_names(items: DataFrame) -> DataFrame:
    """Half as many names per document: each names a pair of neighbours."""
    even = F.col("pos") % 2 == 0
    pairs = materialize(
        items.groupBy("row", F.floor(F.col("pos") / 2).alias("half"))
        .agg(
            F.max("n").alias("n"),
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_NAME)).alias("right"),
        )
        .select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("half").alias("pos"), "left", "right"),
        "pairs",
    )
    names = _numbered(pairs.select("left", "right").distinct(), "left", "right")
    return materialize(pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name"), "named")


def identities(
    docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, keys=None
) -> tuple[DataFrame, DataFrame]:
    """Documents with a row number, and for each row its identity (rounds, name)."""
    folded = fold_ascii(F.coalesce(F.col(text_col), F.lit("")))
    source = text_rows(docs, id_col, text_col)
    texts = source.select(F.col(id_col).alias("doc_id"), once(folded).alias("text"))
    documents, items = _first_names(texts, block_bytes, keys or hash_keys())
    done, rounds = [], 0
    while True:
        done.append(items.filter("n = 1").select("row", F.lit(rounds).alias("rounds"), "name"))
        left = items.filter("n > 1")
        if left.isEmpty():
            break
        items, rounds = _pair_names(left), rounds + 1
    identity = done[0]
    for part in done[1:]:
        identity = identity.unionByName(part)
    return documents, identity


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keys=None,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after lower-casing A-Z; a null text counts as empty. Of equal
    texts the row with the largest id stays, a null id being the smallest; of repeated rows with that same
    id one stays. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    documents, identity = identities(docs, id_col, text_col, block_bytes, keys)
    rows = materialize(documents.join(identity, "row"), "identities")
    groups = materialize(
        rows.groupBy("rounds", "name").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    return rows.join(groups, ["rounds", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns, whatever the names of these are.

    The verdict comes back by id and text. Of rows that repeat both, the one with the smallest JSON text stays.
    """
    verdict = materialize(exact_duplicates(docs, id_col, text_col).filter("kept OR doc_id <=> keep_id"), "verdict")
    staying = materialize(
        verdict.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_print")),
        "staying",
    )
    print_ = F.sha2(fold_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256)
    packed = packed_rows(docs, id=F.col(f"`{id_col}`"), print=print_)
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("print") == F.col("kept_print"))
    kept = packed.join(staying, same, "left_semi")
    if not verdict.filter("NOT kept").isEmpty():
        kept = one_of_each(kept, "id", "print")
    return kept.select("row.*")
