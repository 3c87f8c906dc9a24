"""The corpus operators with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.llm.chat import format_chat
from riskflow.llm.collocations import collocations
from riskflow.llm.exact_dedup import exact_duplicates
from riskflow.llm.language import identify_language, train as train_language
from riskflow.llm.lexical import rank_documents
from riskflow.llm.licenses import scan_licenses
from riskflow.llm.line_dedup import deduplicate_lines
from riskflow.llm.mixing import mix_sources
from riskflow.llm.packing import pack_documents, with_digests
from riskflow.llm.quality import quality_verdicts
from riskflow.llm.simhash import near_duplicates
from riskflow.llm.toxicity import score_toxicity, train as train_toxicity
from riskflow.llm.warc import archived_pages
from riskflow.sources import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify_language(docs, train_language(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return with_digests(pack_documents(read_table(spark, sf_dir, "documents"), tokenizer)).drop("ids")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(read_table(spark, sf_dir, "conversations"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(read_table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for each benchmark item."""
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and lost, and the digest of the text that stays."""
    left = deduplicate_lines(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_quality": op2_quality,
        "op3_toxicity": op3_toxicity,
        "op4_licenses": op4_licenses,
        "op5_mixing": op5_mixing,
        "op6_language": op6_language,
        "op7_packing": op7_packing,
        "op8_chat": op8_chat,
        "op9_warc": op9_warc,
        "op10_simhash": op10_simhash,
        "op11_lexical_search": op11_lexical_search,
        "op12_collocations": op12_collocations,
        "op13_line_dedup": op13_line_dedup,
    }
