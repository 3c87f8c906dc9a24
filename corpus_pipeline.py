"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again before the next one.
All stages but the last keep the columns of documents. Mixing keeps every document and deals them out to files,
each a run of the mix; packing fills sequences from the files that a task reads, so these follow the target
weights.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskflow.llm.exact_dedup import drop_exact_duplicates
from riskflow.llm.mixing import in_mixed_order
from riskflow.llm.packing import pack_documents, with_digests
from riskflow.llm.simhash import drop_near_duplicates
from riskflow.llm.toxicity import drop_toxic, train
from riskflow.session import new_path, run_scope
from riskflow.sinks import write_table
from riskflow.sources import read_table

ORACLE_SQL = None  # learned scores, fingerprints and token ids are beyond SQL


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not find toxic."""
    return drop_toxic(docs, train(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return in_mixed_order(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences."""
    return with_digests(pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the whole pipeline. Of each stage but the last only its result is kept on disk."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        with run_scope(spark):
            kept = stage(spark, docs, sf_dir)
            write_table(kept, path, "errorifexists")
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
