"""What the corpus operators share: input columns, ASCII case folding, batch sizes."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows per Arrow batch. Texts may be very long, so a batch must hold few of them.
BATCH_ROWS = 256


def text_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that no other column of the input can clash with one made here."""
    return df.select(*[F.col(f"`{name}`").alias(name) for name in columns])


def packed_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """``row``, the whole row as one column, and the given columns beside it, which so clash with none of its own."""
    return df.select(F.struct("*").alias("row"), *[value.alias(name) for name, value in columns.items()])


def one_of_each(packed: DataFrame, *key: str) -> DataFrame:
    """Of packed rows that agree in ``key`` the one with the smallest JSON text; rows equal in that are the same."""
    return packed.groupBy(*key).agg(F.min_by("row", F.to_json("row")).alias("row"))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` is faster but right only for texts without other letters."""
    only_ascii = F.length(text) == F.octet_length(text)
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(only_ascii, F.lower(text)).otherwise(folded)


def once(value: Column) -> Column:
    """A generator that computes ``value`` once per row, however often the result is used."""
    return F.explode(F.array(value))


def with_value(value: Column, use) -> Column:
    """``use`` of a value that is computed once, inside one expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small for this session; a batch is what a Python worker holds at a time."""
    current = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < current <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that nothing is learned from. A null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
